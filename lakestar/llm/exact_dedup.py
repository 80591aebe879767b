"""Exact duplicates: binary-fuse filters of immutable snapshots, exact buckets, byte checks."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import narrow_join, stored, widened, without_rows
from lakestar.operators.dedup import orderable_columns
from lakestar.operators.joins import count_rows

# Digests per bucket: a filter and the digests that it screens are one task's work.
KEYS_PER_BUCKET = 100_000
_SEED_STEP = 0x9E3779B97F4A7C15


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three slots of each key, in three consecutive segments."""
    mask = np.uint64(segment - 1)
    first = ((hashes >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (hashes & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) of a binary-fuse filter over uint64 keys.

    Slots with a single key are peeled in rounds; fingerprints are set in the reverse order of the
    rounds. Keys of one round share no slot that the round sets, so each round is one array step.
    """
    keys = np.unique(keys)
    n = len(keys)
    segment = 1 << max(2, min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    size = (segments + 2) * segment
    seed = 0
    while True:
        seed = (seed + _SEED_STEP) % (1 << 64)
        hashes = _mixed(keys, seed)
        slots = _places(hashes, segment, segments)
        count = np.bincount(slots.ravel(), minlength=size)
        owners = np.zeros(size, dtype=np.int64)
        for row in slots:
            np.add.at(owners, row, np.arange(n))
        rounds, left = [], n
        ready = np.flatnonzero(count == 1)
        while len(ready):
            own, where = np.unique(owners[ready], return_index=True)
            rounds.append((own, ready[where]))
            left -= len(own)
            touched = slots[:, own]
            np.subtract.at(count, touched.ravel(), 1)
            np.subtract.at(owners, touched.ravel(), np.tile(own, 3))
            ready = np.unique(touched)
            ready = ready[count[ready] == 1]
        if not left:
            break
    table = np.zeros(size, dtype=np.uint8)
    prints = _prints(hashes)
    for own, slot in reversed(rounds):
        a, b, c = table[slots[:, own]]
        table[slot] = prints[own] ^ a ^ b ^ c  # the slot itself is still 0
    return seed, segment, segments, table.tobytes()


def may_contain(built: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter: always for its keys, for others one time in 256."""
    seed, segment, segments, table = built
    hashes = _mixed(keys, seed)
    a, b, c = np.frombuffer(table, dtype=np.uint8)[_places(hashes, segment, segments)]
    return (a ^ b ^ c) == _prints(hashes)


def _keys(digests: pa.ChunkedArray) -> np.ndarray:
    """The first eight bytes of each digest."""
    heads = b"".join((d[:8] if len(d) >= 8 else d.ljust(8, b"\0")) for d in digests.to_pylist())
    return np.frombuffer(heads, dtype="<u8").astype(np.uint64)


def _build(table: pa.Table) -> pa.Table:
    seed, segment, segments, prints = build_filter(_keys(table["digest"]))
    return pa.table({
        "bucket": table["bucket"].slice(0, 1), "seed": pa.array([seed.to_bytes(8, "little")]),
        "segment": pa.array([segment], pa.int32()), "segments": pa.array([segments], pa.int32()),
        "prints": pa.array([prints], pa.binary()),
    })


def _screen(incoming: pa.Table, filters: pa.Table) -> pa.Table:
    """Incoming digests of one bucket with whether a snapshot may hold them; no filter, no match."""
    maybe = np.zeros(incoming.num_rows, dtype=bool)
    if incoming.num_rows and filters.num_rows:
        keys = _keys(incoming["digest"])
        for row in filters.to_pylist():
            seed = int.from_bytes(row["seed"], "little")
            maybe |= may_contain((seed, row["segment"], row["segments"], row["prints"]), keys)
    return incoming.append_column("maybe", pa.array(maybe))


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest: rows, and id and place of the row that stays."""
    groups = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "place")).alias("keep"))
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def exact_duplicates(
    documents: DataFrame,
    in_snapshot: Column,
    *,
    digest: Callable[[Column], Column] = lambda sha: sha,
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """One row per document row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as the empty text. The row with the largest id
    stays (null ids are smallest; of repeated rows one stays). ``in_snapshot`` marks the rows of the
    immutable snapshot; the others are the incoming batch. Each is grouped by digest on its own. A static
    filter per bucket of the snapshot screens the batch's digests; those that pass join the exact
    buckets. Where a group has several rows, its texts are compared byte by byte, and a digest that
    stands for several texts is divided by the whole SHA-256, so a weak ``digest`` (a function of it)
    changes no result. Empty tables give no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.unhex(F.sha2(text, 256))
    narrow = stored(documents.select(
        F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("place"),
        F.coalesce(in_snapshot, F.lit(False)).alias("old"), sha.alias("sha")), "dedup-digests")
    narrow = narrow.withColumn("digest", digest(F.col("sha")))
    buckets = max(1, -(-count_rows(narrow) // keys_per_bucket))
    old, new = (_grouped(narrow.filter(side), buckets) for side in (F.col("old"), ~F.col("old")))

    filters = old.select("bucket", "digest").groupBy("bucket").applyInArrow(
        _build, "bucket int, seed binary, segment int, segments int, prints binary")
    screened = stored(new.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(
        _screen, widened(new, "maybe boolean")), "dedup-screened")
    passed = screened.filter("maybe").select("digest", F.col("n").alias("more"), F.col("keep").alias("other"))
    old = old.join(passed, "digest", "left").select(
        "digest", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
        F.greatest("keep", F.coalesce("other", "keep")).alias("keep"))
    fresh = screened.filter(~F.col("maybe")).unionByName(
        screened.filter("maybe").join(old.select("digest"), "digest", "left_anti"))
    groups = stored(old.unionByName(fresh.select("digest", "n", "keep")).filter("n > 1"), "dedup-groups")

    # The byte check: one row per digest and text, collapsed before the shuffle.
    rows = documents.select(F.col("doc_id").alias("id"), text.alias("text"), digest(sha).alias("digest"))
    texts = narrow_join(rows, groups.select("digest"), ["digest"], "left_semi").groupBy("digest", "text").agg(
        F.count(F.lit(1)).alias("n"))
    shared = stored(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "dedup-shared")
    if not shared.isEmpty():
        # Digests that stand for several texts: divide their rows by the whole SHA-256.
        parts = narrow.join(shared.select("digest"), "digest", "left_semi")
        apart = parts.groupBy("digest", "sha").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "place")).alias("keep"))
        groups = groups.withColumn("sha", F.lit(None).cast("binary")).join(shared, "digest", "left_anti")
        groups = groups.unionByName(apart)
        on = (F.col("l.digest") == F.col("r.digest")) & F.coalesce(F.col("l.sha") == F.col("r.sha"), F.lit(True))
    else:
        on = F.col("l.digest") == F.col("r.digest")
    found = narrow_join(narrow.alias("l"), groups.alias("r"), on, "left")
    keep = F.coalesce(F.col("r.keep"), F.struct("l.id", "l.place"))
    return found.select(
        F.col("l.id").alias("doc_id"), keep["id"].alias("keep_id"),
        F.coalesce("r.n", F.lit(1)).cast("long").alias("group_size"),
        (keep["place"] == F.col("l.place")).alias("kept"),
        F.lower(F.hex("l.sha")).alias("text_sha256"))


def drop_exact_duplicates(documents: DataFrame, in_snapshot: Column) -> DataFrame:
    """The documents whose row stays, with all their columns.

    Of rows that repeat both id and text, the one that sorts first by its other columns stays; columns that
    have no order, such as maps, count after the others and as JSON. Null texts are empty, null ids come last,
    and an empty table gives no rows.
    """
    decided = stored(exact_duplicates(documents, in_snapshot), "dedup-decided")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    keys = {"doc_id": F.col("doc_id"), "text_sha256": sha}
    gone = decided.filter(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*keys).distinct()
    left = without_rows(documents, gone, keys)
    twice = decided.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*keys).distinct()
    twice = stored(twice, "dedup-twice")
    if twice.isEmpty():
        return left
    once = without_rows(left, twice, keys)
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    renamed = twice.select(*[F.col(k).alias(f"__twice_{k}") for k in keys])
    on = F.col("doc_id").eqNullSafe(F.col("__twice_doc_id")) & (sha == F.col("__twice_text_sha256"))
    sorted_by = orderable_columns(documents, ["doc_id", "text"])
    unordered = [c for c in others if c not in sorted_by]
    order = F.struct(F.lit(0).alias("__first"), *sorted_by, *(
        [F.to_json(F.struct(*unordered)).alias("__rest")] if unordered else []))
    repeated = left.join(renamed, on, "left_semi").groupBy("doc_id", "text").agg(
        F.min_by(F.struct(F.lit(0).alias("__first"), *others), order).alias("__row"))
    repeated = repeated.select("doc_id", "text", *[F.col("__row")[c].alias(c) for c in others])
    return once.unionByName(repeated.select(*documents.columns))
