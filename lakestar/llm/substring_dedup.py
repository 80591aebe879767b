"""Substring dedup: repeated windows of words are found by an FM-index per shard and removed but for the first.

A window's anchor is the word run in it that comes first in one global order of word-run hashes, so equal
windows have equal anchors. Consecutive windows with one anchor form a stretch of text, and stretches are dealt
to shards by their anchor: all occurrences of a window meet in one shard. A shard drops anchors that occur
once, builds a compressed FM-index (a wavelet matrix over the transformed words) of the distinct stretches
that share an anchor, and streams those stretches through backward search: a window whose match is shorter than
the threshold is left behind on the way, the others fall into classes of equal text, of which the earliest
occurrence stays.

Word runs that many documents share come last in the order, so only windows that hold nothing else are dealt
by them; such windows have few different texts, and every task sends each text once, with its earliest place.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import stored
from lakestar.llm.decontaminate import WaveletMatrix
from lakestar.llm.jaccard_join import mixed

# Words of a window (the contract's threshold) and of the runs that anchor it.
WINDOW = 20
RUN = 6
# Characters of texts that are cut at a time, and of texts per shard.
GROUP_CHARS = 2_000_000
SHARD_CHARS = 8_000_000
# Documents sampled to learn which word runs are frequent, the share of them that makes one frequent, and how
# many are kept. They choose where stretches are dealt, never what is found.
SAMPLE = 20_000
FREQUENT = 0.001
MOST_FREQUENT = 20_000
_K = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(1 << 63)
_ZSTD = pa.Codec("zstd", compression_level=1)


def run_hashes(words: np.ndarray, run: int) -> np.ndarray:
    """A hash of every run of so many consecutive word hashes."""
    whole = max(0, len(words) - run + 1)
    out = words[:whole]
    for j in range(1, run):
        out = mixed(out * _K + words[j : whole + j])
    return out


def _hashed(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, words per text)."""
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    words = np.fromiter((digest(w) for s in split for w in s), dtype=np.uint64, count=int(sizes.sum()))
    return mixed(words), sizes


def frequent_runs(documents: DataFrame, run: int) -> np.ndarray:
    """Hashes of word runs that many documents of a bounded sample hold, sorted; at most `MOST_FREQUENT`."""
    rows = documents.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    sample = documents if rows <= SAMPLE else documents.sample(SAMPLE / rows, seed=1)

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _byte_groups(batch["text"]):
                words, sizes = _hashed([t.split() for t in group])
                ends = np.cumsum(sizes)
                own = [np.unique(run_hashes(words[e - n : e], run)) for e, n in zip(ends, sizes)]
                found, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *own]), return_counts=True)
                several = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[several].view(np.int64)), pa.array(counts[several])], names=["run", "n"])

    least = max(8, math.ceil(FREQUENT * min(rows, SAMPLE)))
    counts = sample.select("text").mapInArrow(runs, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "run").limit(MOST_FREQUENT).collect()
    return np.sort(np.array([r["run"] for r in top], dtype=np.int64).view(np.uint64))


def _byte_groups(texts: pa.Array, size: int = GROUP_CHARS) -> Iterator[list[bytes]]:
    """Consecutive texts as bytes, of together about so many; null is the empty text."""
    group, held = [], 0
    for text in texts.cast(pa.binary()).to_pylist():
        group.append(text or b"")
        held += len(group[-1])
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def stretches(
    words: np.ndarray, sizes: np.ndarray, window: int, run: int, frequent: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of each stretch of texts given by their words' hashes.

    Windows are named by the place of their first word; none reaches across texts. The anchor's place is fixed
    within a stretch, so no two of its windows are equal.
    """
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = run_hashes(words, run) >> np.uint64(1)
    if len(frequent):
        raw = run_hashes(words, run)
        at = np.minimum(np.searchsorted(frequent, raw), len(frequent) - 1)
        order |= np.where(frequent[at] == raw, _TOP, np.uint64(0))
    least = np.lib.stride_tricks.sliding_window_view(order, window - run + 1).argmin(axis=1)
    at = np.arange(n) + least
    text = np.repeat(np.arange(len(sizes)), sizes)
    whole = text[:n] == text[window - 1 :]
    opens = whole.copy()
    opens[1:] &= ~(whole[:-1] & (at[1:] == at[:-1]) & (text[1:n] == text[: n - 1]))
    first = np.flatnonzero(opens)
    counts = np.bincount((np.cumsum(opens) - 1)[whole], minlength=len(first)) if len(first) else np.zeros(0, np.int64)
    return order[at[first]], first, counts


def _content(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the words of each stretch, by which a task tells equal ones."""
    ends = np.cumsum(length)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length)
    own = words[np.repeat(first, length) + place]
    seat = mixed(place.astype(np.uint64) + _K)
    return (np.add.reduceat(mixed(own ^ seat), ends - length), np.add.reduceat(mixed((own + seat) * _K), ends - length))


def merged_spans(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of texts united where they overlap or touch, ordered by text and start."""
    if not len(text):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    # Ends so far, kept apart by text.
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + np.cumsum(np.concatenate([[0], np.diff(text) != 0])) * far)
    shifted = start + np.cumsum(np.concatenate([[0], np.diff(text) != 0])) * far
    opens = np.concatenate([[True], shifted[1:] > reach[:-1]])
    opens[1:] |= np.diff(text) != 0
    firsts = np.flatnonzero(opens)
    lasts = np.append(firsts[1:], len(text)) - 1
    return text[firsts], start[firsts], reach[lasts] - (shifted[lasts] - start[lasts])


FACTS = np.dtype([
    ("anchor", "<u8"), ("start", "<i8"), ("words", "<i4"), ("bytes", "<i4"), ("doc_id", "<i8"), ("mark", "<i8"), ("null", "?")])
PACKED = "bucket int, size int, facts binary, text_size int, text binary"
SPANS = "doc_id long, mark long, `start` long, `end` long"


def _pack(bucket: int, facts: np.ndarray, text: bytes) -> tuple:
    # Column after column compresses better than row after row.
    raw = b"".join(np.ascontiguousarray(facts[name]).tobytes() for name in FACTS.names)
    return bucket, len(facts), _ZSTD.compress(raw, asbytes=True), len(text), _ZSTD.compress(text, asbytes=True)


def _unpack(size: int, facts: bytes, text_size: int, text: bytes) -> tuple[np.ndarray, bytes]:
    raw = _ZSTD.decompress(facts, size * FACTS.itemsize, asbytes=True)
    out, at = np.empty(size, FACTS), 0
    for name in FACTS.names:
        kind = FACTS[name]
        out[name] = np.frombuffer(raw, kind, size, at)
        at += size * kind.itemsize
    return out, _ZSTD.decompress(text, text_size, asbytes=True) if text_size else b""


def _cut(documents: DataFrame, window: int, run: int, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Stretches by shard, each distinct one of a group once; buckets below 0 hold spans that are settled."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            ids, marks, at = batch["doc_id"].to_pylist(), batch["mark"].to_pylist(), 0
            for group in _byte_groups(batch["text"]):
                keys = zip(ids[at : at + len(group)], marks[at : at + len(group)])
                at += len(group)
                # Repeated rows are one document; documents go by id, those without one last.
                known = sorted(dict(zip(keys, group)).items(), key=lambda k: (k[0][0] is None, k[0][0] or 0, k[0][1]))
                rows = _packed_group([k for k, _ in known], [t.split() for _, t in known], window, run, buckets, frequent, number)
                number += 1
                if rows:
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["bucket", "size", "facts", "text_size", "text"])

    return documents.mapInArrow(cut, PACKED)


def _packed_group(
    keys: list[tuple[int | None, int]], split: list[list[bytes]], window: int, run: int, buckets: int,
    frequent: np.ndarray, number: int,
) -> list[tuple]:
    """The rows of one group of documents, given in their order."""
    words, sizes = _hashed(split)
    anchor, first, counts = stretches(words, sizes, window, run, frequent)
    if not len(first):
        return []
    length = counts + window - 1
    one, two = _content(words, first, length)
    order = np.lexsort((first, two, one))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    starts = np.cumsum(sizes) - sizes
    text = np.searchsorted(starts, first, side="right") - 1
    # Texts without words share their start with the next one: the last of equals has the words.
    ids = np.array([k[0] or 0 for k in keys], dtype=np.int64)
    marks = np.array([k[1] for k in keys], dtype=np.int64)
    nulls = np.array([k[0] is None for k in keys])

    def facts(text, start, length, anchor, size):
        out = np.empty(len(text), FACTS)
        out["anchor"], out["start"], out["words"], out["bytes"] = anchor, start, length, size
        out["doc_id"], out["mark"], out["null"] = ids[text], marks[text], nulls[text]
        return out

    rows = []
    again = order[~fresh]
    if len(again):
        t, s, e = merged_spans(text[again], first[again], first[again] + length[again])
        rows.append(_pack(-1 - (int(anchor[0] >> np.uint64(20)) + number) % buckets, facts(t, s - starts[t], e - s, 0, 0), b""))
    some = order[fresh]
    where = ((mixed(anchor[some]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    some, where = some[np.argsort(where, kind="stable")], np.sort(where)
    blob = b" ".join([w for s in split for w in s])
    offsets = np.concatenate([[0], np.cumsum(np.fromiter((len(w) for s in split for w in s), np.int64, len(words)) + 1)])
    low, high = offsets[first[some]], offsets[first[some] + length[some]] - 1
    own = facts(text[some], first[some] - starts[text[some]], length[some], anchor[some], high - low)
    edges = np.flatnonzero(np.concatenate([[True], np.diff(where) != 0, [True]]))
    lows, highs = low.tolist(), high.tolist()
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        rows.append(_pack(int(where[a]), own[a:b], b"".join([blob[lows[i] : highs[i]] for i in range(a, b)])))
    return rows


def sorted_places(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes ordered by at least their first ``depth`` symbols."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth:
        following = np.zeros(n, dtype=np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        step *= 2
    return order


class StretchIndex:
    """FM-index of texts of symbols 2.. that are parted by 1 and ended by 0, for patterns up to ``depth``.

    Suffixes need to be ordered to that depth only, since no longer pattern is searched.
    """

    def __init__(self, symbols: np.ndarray, alphabet: int, depth: int):
        order = sorted_places(symbols, depth)
        self.symbols = symbols
        self.matrix = WaveletMatrix(symbols[order - 1], max(1, int(alphabet - 1).bit_length()))
        starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])[:-1]
        # Where the symbol's run begins in the last level: ranks count from there.
        every = np.arange(alphabet)
        self.base = starts - self._down(every, np.zeros(alphabet, dtype=np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places followed down the levels of the wavelet matrix along the bits of their symbols."""
        for level in range(self.matrix.bits):
            one = (symbols >> (self.matrix.bits - 1 - level)) & 1 == 1
            ones = self.matrix._ones(level, at)
            at = np.where(one, self.matrix.levels[level][2] + ones, at - ones)
        return at

    def repeated(self, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(which of the places, their class): those whose next ``length`` symbols occur elsewhere, too.

        Backward search from the last symbol; a place whose match stands alone is left behind at once.
        """
        alive = np.arange(len(places))
        low = np.zeros(len(places), dtype=np.int64)
        high = np.full(len(places), self.matrix.n, dtype=np.int64)
        for step in range(length - 1, -1, -1):
            symbol = self.symbols[places[alive] + step]
            base = self.base[symbol]
            both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = base + both[: len(alive)], base + both[len(alive) :]
            several = high - low > 1
            alive, low, high = alive[several], low[several], high[several]
        return alive, low


def _judged(window: int):
    """The task of a shard: from its packed stretches the spans of words to remove."""

    def spans_of(facts: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
        return pa.table({
            "doc_id": pa.array(facts["doc_id"], mask=facts["null"]), "mark": pa.array(facts["mark"]),
            "start": pa.array(start), "end": pa.array(end)})

    def judge(table: pa.Table) -> pa.Table:
        parts = [_unpack(*row) for row in zip(*(table[c].to_pylist() for c in ("size", "facts", "text_size", "text")))]
        facts = np.concatenate([f for f, _ in parts])
        if table["bucket"][0].as_py() < 0:
            return spans_of(facts, facts["start"], facts["start"] + facts["words"])
        # Anchors that occur once have no repeated window.
        _, kind, counts = np.unique(facts["anchor"], return_inverse=True, return_counts=True)
        several = counts[kind] > 1
        texts, at = [], 0
        for own, blob in parts:
            ends = np.cumsum(own["bytes"], dtype=np.int64)
            chosen = np.flatnonzero(several[at : at + len(own)])
            low, high = (ends - own["bytes"])[chosen].tolist(), ends[chosen].tolist()
            texts += [blob[a:b] for a, b in zip(low, high)]
            at += len(own)
        del parts
        facts, kind = facts[several], kind[several]
        if not len(facts):
            return spans_of(facts, facts["start"], facts["start"])
        numbers: dict[bytes, int] = {}
        content = np.fromiter((numbers.setdefault(t, len(numbers)) for t in texts), np.int64, len(texts))
        # Documents in their order; a place is the document's rank and the word's number.
        order = np.lexsort((facts["mark"], facts["doc_id"], facts["null"]))
        moved = np.zeros(len(order), dtype=bool)
        moved[1:] = np.any([np.diff(facts[c][order].astype(np.int64)) != 0 for c in ("null", "doc_id", "mark")], axis=0)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(moved)
        key = (rank << 40) + facts["start"]
        order = np.lexsort((key, content))
        opens = np.concatenate([[True], np.diff(content[order]) != 0])
        first = order[opens]  # the earliest place of each content
        later = key > key[first[content]]
        found = [(np.flatnonzero(later), facts["start"][later], facts["start"][later] + facts["words"][later])]
        found.append(_partly(list(numbers), facts, kind, key, first, window))
        rows, start, end = (np.concatenate(c) for c in zip(*found))
        text, start, end = merged_spans(rank[rows], start, end)
        ranked = np.zeros(int(rank.max()) + 1, dtype=np.int64)
        ranked[rank] = np.arange(len(rank))
        return spans_of(facts[ranked[text]], start, end)

    return judge


def _partly(
    contents: list[bytes], facts: np.ndarray, kind: np.ndarray, key: np.ndarray, first: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end): windows of first occurrences that another stretch of the same anchor holds earlier."""
    shared = np.flatnonzero(np.bincount(kind[first], minlength=int(kind.max()) + 1)[kind[first]] > 1)
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    vocabulary: dict[bytes, int] = {}
    split = [contents[i].split() for i in shared.tolist()]
    words = np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 2) for s in split for w in s), np.int64)
    sizes = facts["words"][first[shared]].astype(np.int64)
    symbols = np.append(np.insert(words, np.cumsum(sizes)[:-1], 1), 0)
    index = StretchIndex(symbols, len(vocabulary) + 2, window)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    counts = sizes - window + 1
    owner = np.repeat(np.arange(len(shared)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    some, which = index.repeated(begins[owner] + offset, window)
    row = first[shared[owner[some]]]
    place = key[row] + offset[some]
    order = np.lexsort((place, which))
    earliest = np.concatenate([[True], np.diff(which[order]) != 0])
    again = np.sort(order[~earliest])
    start = facts["start"][row[again]] + offset[some[again]]
    return row[again], start, start + window


def repeated_words(documents: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_text`` of every document row.

    Words are parted by ASCII white space and compared as they are. A window of consecutive words of one text is
    a repeat if its words also start earlier: in a document of smaller id, or earlier in the same one. All words
    of repeats are removed; ``spans`` lists them (words, end exclusive) and ``kept_text`` joins the rest by one
    blank. Windows are judged on the input.

    Other columns are ignored. Null and empty texts, and texts shorter than a window, lose nothing. Rows that
    repeat an id and its text are one document and get the same result; rows of one id with different texts are
    ordered by a hash of the text, rows without an id come last. An empty table gives no rows. Texts of any length
    are read whole, one group of texts at a time.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    chars = documents.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, -(-chars // SHARD_CHARS))
    frequent = frequent_runs(rows, run)
    packed = _cut(rows, window, run, buckets, frequent)
    spans = stored(packed.groupBy("bucket").applyInArrow(_judged(window), SPANS), "substring-spans")
    spans = spans.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, merged, kept = [], [], [], []
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for text, found in zip(texts, batch["spans"].to_pylist()):
                words, own, removed = (text or b"").split(), [], 0
                for span in sorted(found or [], key=lambda s: s["start"]):
                    if own and span["start"] <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], span["end"])
                    else:
                        own.append(span)
                n_words.append(len(words))
                for span in reversed(own):
                    removed += span["end"] - span["start"]
                    del words[span["start"] : span["end"]]
                n_removed.append(removed)
                merged.append(own)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(merged, REMOVED), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return joined.select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_text string")


REMOVED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
