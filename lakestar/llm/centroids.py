"""Centroid clustering by dimension-sharded Lloyd rounds in exact integers.

Vectors are cut into chunks of rows and blocks of columns; a record of the stored table is one block of one
chunk. In a round every block yields exact partial distances of its rows to its slices of the centroids; the
partial distances of a chunk are added by key, and the least sum assigns its rows. The assignments, a number
per row, go back to the blocks, and each block updates its own slices from its own columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import stored

# Rows of a chunk and columns of a block.
CHUNK_ROWS = 4096
BLOCK_COLUMNS = 32
# Assignments (a byte per row for up to 256 centroids) are broadcast up to this counted number of rows.
BROADCAST_ROWS = 64 << 20
# Integers up to here square and add up in 64 bits for any block; larger ones are checked.
_SMALL = 1 << 26

Slices = dict[int, np.ndarray]


def whole_vectors(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the kept vectors, floor(scale * x) of their components as 64-bit integers).

    A vector is kept when it has that many components, none of them null or not finite.
    """
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dimensions), False)
    places = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    flat = column.filter(right).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = flat.reshape(-1, dimensions)
    finite = np.isfinite(x).all(axis=1)
    v = np.floor(x[finite] * scale)
    if len(v) and np.abs(v).max() >= 2.0**62:
        raise OverflowError("a component is too large for exact distances in 64 bits")
    return places[finite], v.astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Integers in the narrowest of 16, 32 and 64 bits that holds all of them."""
    for kind in ("<i2", "<i4"):
        info = np.iinfo(kind)
        if not values.size or (values.min() >= info.min and values.max() <= info.max):
            return values.astype(kind).tobytes()
    return values.astype("<i8").tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    """The integers of `packed`, of which there are ``count``."""
    return np.frombuffer(data, dtype=f"<i{len(data) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


def partial_distances(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids over some columns; fails where one does not fit 64 bits."""
    out = np.empty((len(values), len(centroids)), dtype=np.int64)
    small = max(np.abs(values).max(initial=0), np.abs(centroids).max(initial=0)) < _SMALL
    for j, centroid in enumerate(centroids):
        gap = values - centroid
        if not small:
            _check((gap.astype(np.float64) ** 2).sum(axis=1))
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def _check(estimate: np.ndarray) -> None:
    if len(estimate) and estimate.max() >= 2.0**62.9:
        raise OverflowError("a squared distance does not fit 64 bits")


def _shard(vectors: DataFrame, dimensions: int, scale: int, k: int, seed: int) -> DataFrame:
    """Records ``chunk, block, n, data``; block -1 holds the chunk's ids and its k first candidates to start."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            places, values = whole_vectors(batch["embedding"], dimensions, scale)
            ids = batch["vec_id"].take(pa.array(places)).to_pylist()
            rows = []
            for at in range(0, len(ids), CHUNK_ROWS):
                mine, own = ids[at : at + CHUNK_ROWS], values[at : at + CHUNK_ROWS]
                known = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), own[j].tolist())
                               for j, i in enumerate(mine) if i is not None)[:k]
                rest = sorted(own[j].tolist() for j, i in enumerate(mine) if i is None)[:k]
                starts = [{"hash": h, "vector": v} for h, v in known] + [{"hash": None, "vector": v} for v in rest]
                rows.append((number, -1, len(mine), None, mine, starts))
                for block, low in enumerate(range(0, dimensions, BLOCK_COLUMNS)):
                    rows.append((number, block, len(mine), packed(own[:, low : low + BLOCK_COLUMNS]), None, None))
                number += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), RECORD.types)], schema=RECORD)

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(
        cut, "chunk long, block int, n int, data binary, ids array<bigint>, "
        "starts array<struct<hash:string,vector:array<bigint>>>")


RECORD = pa.schema([
    ("chunk", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("data", pa.binary()),
    ("ids", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.struct([("hash", pa.string()), ("vector", pa.list_(pa.int64()))]))),
])


def _assigned(blocks: DataFrame, slices: Slices, k: int, distances: bool) -> DataFrame:
    """``chunk, n, clusters`` and, if wanted, ``distances``: partial distances added by chunk, then the least."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for block, n, data in zip(*(batch[c].to_pylist() for c in ("block", "n", "data"))):
                centroids = slices[block]
                found = partial_distances(unpacked(data, n * centroids.shape[1]).reshape(n, -1), centroids)
                parts.append(packed(found))
            yield pa.RecordBatch.from_arrays(
                [batch["chunk"], batch["n"], pa.array(parts, pa.binary())], names=["chunk", "n", "part"])

    def added(table: pa.Table) -> pa.Table:
        n = table["n"][0].as_py()
        total = np.zeros((n, k), dtype=np.int64)
        for part in table["part"].to_pylist():
            more = unpacked(part, n * k).reshape(n, k)
            if total.max(initial=0) >= 1 << 61 or more.max(initial=0) >= 1 << 61:
                _check(total.astype(np.float64).max(axis=1) + more.max(axis=1))
            total += more
        least = total.argmin(axis=1)  # the first of equals
        far = total[np.arange(n), least].tobytes() if distances else None
        return pa.table({
            "chunk": table["chunk"].slice(0, 1), "n": table["n"].slice(0, 1),
            "clusters": pa.array([packed(least)], pa.binary()), "distances": pa.array([far], pa.binary())})

    parts = blocks.select("chunk", "block", "n", "data").mapInArrow(partial, "chunk long, n int, part binary")
    return parts.groupBy("chunk").applyInArrow(added, "chunk long, n int, clusters binary, distances binary")


def _updated(blocks: DataFrame, assigned: DataFrame, slices: Slices, k: int, rows: int) -> Slices:
    """The slices after each block has added up its columns per cluster; the sums are k per column."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, n, data, clusters in zip(*(batch[c].to_pylist() for c in ("block", "n", "data", "clusters"))):
                width = slices[block].shape[1]
                values, own = unpacked(data, n * width).reshape(n, width), unpacked(clusters, n)
                exact = np.int64 if np.abs(values).max(initial=0) < 1 << 40 else object
                here = np.zeros((k, width), dtype=exact)
                for j in range(k):
                    here[j] = values[own == j].astype(exact).sum(axis=0)
                total[block] = total.get(block, 0) + here.astype(object)
                counts[block] = counts.get(block, 0) + np.bincount(own, minlength=k)
        out = [(block, j, c, int(counts[block][j]), Decimal(int(total[block][j, c])))
               for block in total for j in range(k) if counts[block][j] for c in range(total[block].shape[1])]
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["block", "cluster", "place", "count", "total"])

    clusters = assigned.select("chunk", "clusters")
    if rows <= BROADCAST_ROWS:
        clusters = F.broadcast(clusters)
    joined = blocks.select("chunk", "block", "n", "data").join(clusters, "chunk")
    parts = joined.select("block", "n", "data", "clusters").mapInArrow(
        sums, "block int, cluster int, place int, count long, total decimal(38,0)")
    found = parts.groupBy("block", "cluster", "place").agg(F.sum("count").alias("count"), F.sum("total").alias("total"))
    slices = {block: centroids.copy() for block, centroids in slices.items()}
    for row in found.collect():  # one row per centroid and column
        slices[row["block"]][row["cluster"], row["place"]] = int(row["total"]) // int(row["count"])
    return slices


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, seed: int = 3
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept row of ``vectors``.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are ignored. Rows whose embedding is null, has
    another length, or a null or non-finite component are left out; so an empty table, or one without kept rows,
    gives no rows. The k kept rows with the least sha256 of ``seed:vec_id`` start; rows that repeat an id are
    ordered by their components, rows without an id come last, and with fewer kept rows there are fewer
    centroids. Repeated rows count as often as they occur. Equal distances go to the smaller number, and a
    centroid without rows stays. All sums are exact; a squared distance beyond 64 bits fails the job.

    The driver holds the centroids only (k times ``dimensions``). Tasks hold one batch of blocks, and no key
    gathers more than the blocks of one chunk, so no cluster, however large, is collected in a task.
    """
    spark = vectors.sparkSession
    shards = stored(_shard(vectors, dimensions, scale, k, seed), "clustering-shards")
    heads, blocks = shards.filter("block < 0"), shards.filter("block >= 0")
    rows = heads.agg(F.sum("n").alias("n")).first()["n"] or 0
    first = heads.select(F.explode("starts").alias("s")).select("s.*").orderBy(F.asc_nulls_last("hash"), "vector").limit(k)
    start = np.array([r["vector"] for r in first.collect()], dtype=np.int64).reshape(-1, dimensions)
    k = len(start)
    slices = {b: start[:, low : low + BLOCK_COLUMNS] for b, low in enumerate(range(0, dimensions, BLOCK_COLUMNS))}
    if k:
        for _ in range(rounds):
            assigned = stored(_assigned(blocks, slices, k, False), "clustering-round")
            slices = _updated(blocks, assigned, slices, k, rows)
    final = stored(_assigned(blocks, slices, max(1, k), True), "clustering-last")

    def unfold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, n, clusters, far in zip(*(batch[c].to_pylist() for c in ("ids", "n", "clusters", "distances"))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(unpacked(clusters, n).astype(np.int32)), pa.array(np.frombuffer(far, "<i8"))],
                    names=["vec_id", "cluster", "distance"])

    placed = heads.select("chunk", "ids").join(final, "chunk").select("ids", "n", "clusters", "distances")
    placed = placed.mapInArrow(unfold, "vec_id long, cluster int, distance long")
    inertia = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    total = sum(int(r["d"]) for r in inertia)
    whole = np.concatenate([slices[b] for b in sorted(slices)], axis=1)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in whole.tolist()]
    facts = [(r["cluster"], int(r["d"]), total, digests[r["cluster"]]) for r in inertia]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
