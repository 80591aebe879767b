"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import free_name, open_file, release_memory, stored, widened
from lakestar.llm.tokenizer_words import groups_of_text

# Fixed value of the contract: words of a window.
WINDOW = 13
# Bytes of benchmark text in a block; a task holds the phrases of one block at a time.
BLOCK_BYTES = 8 << 20
# Characters of the documents of a shard; a longer text is one of its own.
SHARD_CHARS = 2_000_000
# Every so many text positions keep their place, and ranks are summed every 64 symbols.
SAMPLE = 16

# Letters A-Z in lower case; ASCII other than letters and digits parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class WaveletMatrix:
    """Ranks and symbols of an integer sequence, by one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits, self.levels = len(symbols), bits, []
        rest = symbols
        for bit in reversed(range(bits)):
            ones = (rest >> bit) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            packed = np.pad(packed, (0, 8 * (self.n // 64 + 1) - len(packed))).view("<u8")
            sums = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            self.levels.append((packed, sums, self.n - int(sums[-1])))
            rest = np.concatenate([rest[~ones], rest[ones]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        packed, sums, _ = self.levels[level]
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return sums[word] + np.bitwise_count(packed[word] & below)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for level in range(self.bits):
            one = (symbols >> (self.bits - 1 - level)) & 1 == 1
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            zeros = self.levels[level][2]
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return high - low

    def symbols(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        found = np.zeros_like(at)
        for level in range(self.bits):
            packed, _, zeros = self.levels[level]
            one = (packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, at)
            found = found << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return found


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the compared length until all ranks differ."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        following = np.zeros(n, dtype=np.int64)
        following[: max(0, n - step)] = rank[step:] + 1
        key = rank * (max(n, int(rank.max(initial=0)) + 1) + 2) + following
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search over a sequence of symbols 1.. that ends in one 0."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_array(symbols)
        self.last = WaveletMatrix(symbols[order - 1], max(1, int(alphabet - 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        self.kept = np.full(len(order), -1, dtype=np.int64)
        sampled = np.flatnonzero(order % SAMPLE == 0)
        self.kept[sampled] = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; phrases are aligned right and filled up with -1."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.last.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            alive, symbol = alive[symbol >= 0], symbol[symbol >= 0]
            start = self.before[symbol]
            low[alive] = start + self.last.rank(symbol, low[alive])
            high[alive] = start + self.last.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled position."""
        places, steps = np.zeros(len(rows), dtype=np.int64), 0
        open_rows, at = np.arange(len(rows)), rows
        while len(open_rows):
            known = self.kept[at] >= 0
            places[open_rows[known]] = self.kept[at[known]] + steps
            open_rows, at = open_rows[~known], at[~known]
            symbol = self.last.symbols(at)
            at = self.before[symbol] + self.last.rank(symbol, at)
            steps += 1
        return places


@dataclass(frozen=True)
class Phrases:
    """The windows of a block of items: symbols 2.. are words, 1 parts runs, 0 ends the text."""

    vocabulary: dict[bytes, int]
    phrases: np.ndarray  # aligned right, -1 before
    lengths: np.ndarray
    items: list[list[str]]  # of each phrase

    @classmethod
    def of(cls, items: Iterable[tuple[object, str | None]], window: int) -> Phrases:
        found: dict[tuple[bytes, ...], dict[str, None]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[i : i + window]), {})[str(item)] = None
        vocabulary = {w: i + 2 for i, w in enumerate(sorted({w for p in found for w in p}))}
        phrases = np.full((len(found), window), -1, dtype=np.int64)
        for row, phrase in zip(phrases, found):
            row[window - len(phrase):] = [vocabulary[w] for w in phrase]
        lengths = np.array([len(p) for p in found], dtype=np.int64)
        return cls(vocabulary, phrases, lengths, [list(i) for i in found.values()])


@lru_cache(maxsize=1)
def _load(uri: str, window: int) -> Phrases:
    """The phrases of one block; a task keeps one block."""
    files, path = open_file(uri)
    with files.open_input_file(path) as file:
        table = pq.read_table(file, columns=["item_id", "text"])
    return Phrases.of(zip(table["item_id"].to_pylist(), table["text"].to_pylist()), window)


def find_spans(texts: list[list[bytes]], block: Phrases) -> tuple[np.ndarray, list[set[str]]]:
    """Marks of all words of a shard that lie in an occurrence, and the items found in each document.

    Words of no phrase become one parting symbol, and runs of other words that are shorter than the
    shortest phrase cannot hold one: the index is built over the rest.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    total = int(sizes.sum())
    hit, items = np.zeros(total, dtype=bool), [set() for _ in texts]
    if not len(block.phrases) or not total:
        return hit, items
    get = block.vocabulary.get
    ids = np.fromiter((get(w, 1) for t in texts for w in t), dtype=np.int64, count=total)
    known = ids > 1
    ends = np.cumsum(sizes)
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    firsts = (ends - sizes)[sizes > 0]
    opens[firsts] = known[firsts]  # a run ends with its document
    run = np.cumsum(opens) - 1
    long_runs = np.bincount(run[known], minlength=run[-1] + 1) >= block.lengths.min()
    places = np.flatnonzero(known)
    places = places[long_runs[run[places]]]
    if not len(places):
        return hit, items
    # Runs one after the other, each followed by the parting symbol, then the end.
    parts = np.flatnonzero(np.diff(run[places])) + 1
    stream = np.append(np.insert(ids[places], parts, 1), 0)
    origin = np.append(np.insert(places, parts, -1), -1)
    index = FMIndex(stream, len(block.vocabulary) + 2)
    low, high = index.search(block.phrases)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    starts = origin[index.locate(rows)]
    edges = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + block.lengths[which], -1)
    hit = np.cumsum(edges[:-1]) > 0
    document = np.searchsorted(ends, starts, side="right")
    for pair in np.unique(document * len(counts) + which):
        items[pair // len(counts)].update(block.items[pair % len(counts)])
    return hit, items


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Merged spans [start, end) of marked words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES, name: str = "__hits") -> DataFrame:
    """The documents' columns and one called ``name``, which replaces an own one: a struct of n_words, n_hit, n_items, items_sha256,
    contaminated and spans (of words, end exclusive).

    A word is hit when it lies in an occurrence of a window of consecutive item words, or of a whole item
    of fewer. The benchmark is written in blocks of bounded size to the shared folder; a task works
    through them one after the other for each shard (consecutive documents of bounded size) and merges their
    spans, so nothing is shuffled or sent to the driver and results do not depend on blocks or shards.
    Null and empty texts have no words and no hits; a null item id counts as ``None``; items without words
    and an empty benchmark hit nothing. Repeated rows get the same result each, and an empty table gives no rows.
    """
    documents = documents.drop(name)
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = benchmark.select("item_id", "text").repartition(max(1, -(-size // block_bytes)), F.xxhash64("text"))
    uris = stored(blocks, "benchmark").inputFiles()

    def found_in(shards: list[list[str]]) -> list[tuple[list[int], np.ndarray, list[set[str]]]]:
        """Words per text, marks of words and items per text of each shard; each block is loaded once."""
        results: list[tuple[list[int], np.ndarray, list[set[str]]]] = []
        for uri in uris or [None]:
            block = _load(uri, window) if uri else Phrases.of([], window)
            for at, shard in enumerate(shards):
                texts = [words_of(t) for t in shard]
                hit, items = find_spans(texts, block)
                if at == len(results):
                    results.append(([len(t) for t in texts], hit, items))
                else:
                    results[at][1][hit] = True
                    for have, new in zip(results[at][2], items):
                        have |= new
        return results

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sizes, hit, items in found_in(list(groups_of_text(batch["text"].to_pylist(), SHARD_CHARS))):
                ends = np.cumsum(sizes)
                for size, end, have in zip(sizes, ends, items):
                    own = hit[end - size : end]
                    n_hit = int(own.sum())
                    rows.append({
                        "n_words": size, "n_hit": n_hit, "n_items": len(have),
                        "items_sha256": hashlib.sha256(",".join(sorted(have)).encode()).hexdigest(),
                        "contaminated": n_hit > 0 and 20 * n_hit >= size,
                        "spans": [{"start": a, "end": b} for a, b in spans(own)] if n_hit else [],
                    })
            release_memory()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, HITS)], names=[*batch.schema.names, name])

    out = widened(documents, f"`{name}` struct<n_words:bigint,n_hit:bigint,n_items:bigint,items_sha256:string,contaminated:boolean,"
                  "spans:array<struct<start:bigint,end:bigint>>>")
    return documents.mapInArrow(judge, out)


HITS = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()),
    ("contaminated", pa.bool_()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names."""
    name = free_name(documents, "__hits")
    judged = benchmark_hits(documents, benchmark, window, name=name)
    return judged.filter(~F.col(name)["contaminated"]).select(*documents.columns)
