"""Importance resampling towards a target: array-scored weights, drawn by parallel sorting by regular sampling.

Counts of hashed word n-grams of the corpus and of the target give a gain per bucket, an array of fixed size; a
document's weight is the sum of the gains of its n-grams, and a seeded Gumbel term makes the highest scores a
sample without replacement. Ranks are exact: every task sorts its run, regular samples of the runs give
splitters, the segments between splitters are exchanged and merged, and counts of the segments before give
each row its rank.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import stored
from lakestar.llm.tokenizer_words import groups_of_text

# Parameters of the contract's query.
BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Characters of texts whose words are held at a time, and samples taken of all runs together, or one of each.
GROUP_CHARS = 1_000_000
SAMPLES = 200_000

# Letters A-Z in lower case; ASCII other than letters and digits parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# Lengths below this are looked up; longer ones are put together from powers of two.
_SHORT = 64


def split_words(text: str) -> list[bytes]:
    """The lower-cased words of a text."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@lru_cache(maxsize=1)
def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """Tables that move a CRC-32 over following zero bytes: by 0 to 63 bytes, and by 2**i bytes.

    The move is linear, so it is the exclusive or of the moves of the four bytes of the checksum.
    """
    byte = np.array([zlib.crc32(bytes([i])) for i in range(256)], dtype=np.uint32)
    step = byte ^ byte[0]  # one byte of the register through eight shifts

    def table(move) -> np.ndarray:
        return np.stack([move(np.arange(256, dtype=np.uint32) << np.uint32(8 * b)) for b in range(4)])

    def one(c: np.ndarray) -> np.ndarray:
        return (c >> np.uint32(8)) ^ step[c & np.uint32(255)]

    short = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])]
    for _ in range(1, _SHORT):
        short.append(table(lambda c, t=short[-1]: one(_moved(c, t))))
    powers = [short[1]]
    for _ in range(1, 48):
        powers.append(table(lambda c, t=powers[-1]: _moved(_moved(c, t), t)))
    return np.stack(short), np.stack(powers)


def _moved(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Checksums moved by one table."""
    out = table[0][c & np.uint32(255)]
    for b in range(1, 4):
        out = out ^ table[b][(c >> np.uint32(8 * b)) & np.uint32(255)]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from those of both and the length of the second."""
    short, powers = _shifts()
    low = length & (_SHORT - 1)
    out = short[low, 0, first & np.uint32(255)]
    for b in range(1, 4):
        out ^= short[low, b, (first >> np.uint32(8 * b)) & np.uint32(255)]
    rest = length >> 6
    bit = 6
    while rest.any():
        some = np.flatnonzero(rest & 1)
        out[some] = _moved(out[some], powers[bit])
        rest, bit = rest >> 1, bit + 1
    return out ^ second


def feature_buckets(texts: list[str], buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every run of 1 to ``longest`` words, place of its text, words of each text)."""
    split = [split_words(t) for t in texts]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    total = int(sizes.sum())
    crc = np.fromiter((zlib.crc32(w) for s in split for w in s), dtype=np.uint32, count=total)
    length = np.fromiter((len(w) for s in split for w in s), dtype=np.int64, count=total)
    place = np.repeat(np.arange(len(texts)), sizes)
    found, places = [crc], [place]
    blank = joined_crc(np.full(total, zlib.crc32(b" "), dtype=np.uint32), crc, length)
    run = crc
    for n in range(2, longest + 1):
        if total < n:
            break
        # A run of n words is the run of n - 1 words before it, a blank and the next word.
        run = joined_crc(run[: total - n + 1], blank[n - 1 :], length[n - 1 :] + 1)
        inside = place[: total - n + 1] == place[n - 1 :]
        found.append(run[inside])
        places.append(place[: total - n + 1][inside])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(places), sizes


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many n-grams of all texts fall in each bucket: an array of the fixed number of buckets."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for group in groups_of_text(batch["text"].to_pylist(), GROUP_CHARS):
                counts += np.bincount(feature_buckets(group, buckets, longest)[0], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths, rounded down: the log of target over corpus frequency."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))))
        for s, t in zip(corpus, target)], dtype=np.int64)


def gumbel(seed: int, doc_id: int | None) -> int:
    """The seeded random term of a document in thousandths, rounded down."""
    from hashlib import sha256

    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(documents: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for group in groups_of_text(batch["text"].to_pylist(), GROUP_CHARS):
                bucket, place, sizes = feature_buckets(group, len(gain), longest)
                words.append(sizes)
                features.append(np.bincount(place, minlength=len(group)))
                # Sums of integers far below 2**53 are exact in doubles.
                weights.append(np.bincount(place, gain[bucket], len(group)).astype(np.int64))
            none = [np.zeros(0, np.int64)]
            words, features, weights = (np.concatenate(none + c) for c in (words, features, weights))
            scores = weights + np.array([gumbel(seed, d) for d in batch["doc_id"].to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in (words, features, weights, scores))],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def _runs(scored: DataFrame, least_words: int) -> DataFrame:
    """Every partition sorted by falling score and id, each row with its run and place: a total order.

    The rows that are too short to be drawn follow after the others.
    """

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, run, dtype=np.int64)), pa.array(np.arange(at, at + n))],
                names=[*batch.schema.names, "run", "place"])
            at += n

    ordered = scored.sortWithinPartitions(
        F.col("n_words") < least_words, F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features")
    return ordered.mapInArrow(
        number, "doc_id long, n_words long, n_features long, weight long, score long, run long, place long")


def _key(score: int, doc_id: int | None, run: int, place: int) -> tuple:
    """Ascending sort key of a row: falling score, then id with null last, then run and place."""
    return -score, doc_id is None, doc_id or 0, run, place


def splitters(samples: list[tuple[tuple, int]], segments: int) -> list[tuple]:
    """Keys that cut the weighted samples into segments of about equal weight."""
    samples = sorted(samples)
    total, seen, cuts = sum(w for _, w in samples), 0, []
    for key, weight in samples:
        if seen * segments >= (len(cuts) + 1) * total and len(cuts) < segments - 1:
            cuts.append(key)
        seen += weight
    return cuts


def ranked(runs: DataFrame) -> DataFrame:
    """The rows of stored sorted runs with ``rank``, 1 for the first of all, by regular sampling.

    Each run gives samples at regular steps, weighted by the rows that they stand for; there are as many
    segments as runs. The driver sees the samples (at most `SAMPLES`, or one per run), the splitters and a
    count per segment. Keys are unique through run and place, so rows that tie in score and id are
    cut like others and no segment grows with a hot value.
    """
    spark = runs.sparkSession
    lengths = {r["run"]: r["n"] for r in runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_run = max(1, SAMPLES // max(1, len(lengths)))
    step = F.greatest(F.lit(1), F.ceil(F.col("n") / per_run)).cast("long")
    sizes = spark.createDataFrame(list(lengths.items()), "run long, n long")
    sampled = runs.join(F.broadcast(sizes), "run").withColumn("step", step)
    sampled = sampled.filter(F.col("place") % F.col("step") == 0).select("score", "doc_id", "run", "place", "step").collect()
    cuts = splitters([(_key(*r[:4]), r["step"]) for r in sampled], len(lengths))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("score", "doc_id", "run", "place")))
            segment = pa.array([bisect_left(cuts, _key(*r)) for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, segment], names=[*batch.schema.names, "segment"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            at = []
            for segment in batch["segment"].to_pylist():
                seen[segment] = seen.get(segment, 0) + 1
                at.append(seen[segment])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "within"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields)
    dealt = runs.mapInArrow(deal, f"{fields}, segment int").repartitionById(len(cuts) + 1, "segment")
    merged = dealt.sortWithinPartitions(
        "segment", F.desc("score"), F.asc_nulls_last("doc_id"), "run", "place").mapInArrow(merge, f"{fields}, segment int, within long")
    merged = stored(merged, "resample-segments")
    counts = {r["segment"]: r["n"] for r in merged.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for segment in range(len(cuts) + 1):
        offsets.append((segment, before))
        before += counts.get(segment, 0)
    offsets = spark.createDataFrame(offsets, "segment int, before long")
    return merged.join(F.broadcast(offsets), "segment").withColumn("rank", F.col("before") + F.col("within"))


def resample(
    documents: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, longest: int = LONGEST,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document row; ``rank`` is null unless it is drawn.

    Both tables need ``text``; other columns are ignored. Null and empty texts have no words, weight 0 and a
    score, and are never drawn, like all texts below ``least_words`` words. Of the N others floor(percent * N /
    100) are drawn. Ties in score go to the smaller id, then to the lesser weight and count of features; rows that
    repeat an id and a text are drawn each for itself, and rows without an id come last among equals. An empty
    corpus gives no rows, an empty target gains like a uniform one. Texts of any length are read whole.
    """
    gain = gains(bucket_counts(documents, buckets, longest), bucket_counts(target, buckets, longest))
    runs = stored(_runs(_scored(documents, gain, longest, seed), least_words), "resample-runs")
    able = runs.filter(F.col("n_words") >= least_words)
    n = able.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    drawn = percent * n // 100
    columns = ("doc_id", "n_features", "weight", "score")
    rest = runs.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not n:
        return rest
    placed = ranked(able).select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return placed.unionByName(rest)
