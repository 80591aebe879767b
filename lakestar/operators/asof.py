"""Point-in-time look-up: the version of an entity that was valid at the time of a row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.operators.chunks import CHUNK, hot_counts, with_chunks
from lakestar.operators.joins import BROADCAST_ROWS, HOT_ROWS, lookup_join

AT, SIDE, ROW, VERSION = "__at", "__side", "__row", "__version"


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    take: Sequence[str],
    *,
    start: str = "valid_from",
    end: str = "valid_to",
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every row once, with the columns ``take`` of the version of its key that is valid at its time.

    A version is valid from ``start`` up to, not including, ``end``; an open ``end`` is null. Versions are
    unique by key and start, as the functions of this package leave them. A row before the first
    version, in a gap, or without a key or a time has nulls. Rows that arrive late are placed by their own
    time like any other.

    No pair of rows is formed: versions and rows of a key are united, sorted by time, and the last version
    is carried forward, with one shuffle. Where a key has ``hot_rows`` rows, its distinct times are
    resolved instead, in chunks of time with one row per chunk across their edges, and the rows look their
    time up in a join that salts hot keys; so neither many rows nor many versions of a key, nor many rows
    of one key and time, end in one task.
    """
    clash = set(take) & set(rows.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both tables")
    keys, kind = list(keys), versions.schema[start].dataType
    at = F.col(time).cast(kind)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # A row without a key or a time has an empty place and meets no version.
    placed = rows.withColumn(AT, F.when(known, at))
    complete, rest = placed.filter(F.col(AT).isNotNull()), placed.filter(F.col(AT).isNull())
    rest = rest.select(*rows.columns, *(F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in take))
    valid = versions.filter(known & F.col(start).isNotNull()).select(
        *keys, F.col(start).alias(AT), F.lit(0).alias(SIDE),
        F.struct(F.col(end).alias("__end"), F.struct(*take).alias("taken")).alias(VERSION))
    hot, n_hot, most = hot_counts(complete.select(*keys).unionAll(valid.select(*keys)), keys, hot_rows)
    if not n_hot:
        side = complete.select(*keys, AT, F.lit(1).alias(SIDE), F.struct(*rows.columns).alias(ROW))
        both = valid.unionByName(side, allowMissingColumns=True)
        window = Window.partitionBy(*keys).orderBy(AT, SIDE).rowsBetween(Window.unboundedPreceding, 0)
        carried = both.withColumn(VERSION, F.last(VERSION, ignorenulls=True).over(window)).filter(F.col(SIDE) == 1)
        found = carried.select(f"{ROW}.*", *_taken(take))
        return found.unionByName(rest)
    points = complete.select(*keys, AT).distinct().withColumn(SIDE, F.lit(1))
    both = with_chunks(valid.unionByName(points, allowMissingColumns=True), keys, AT, hot, n_hot, most, hot_rows)
    resolved = _carried_across_chunks(both, keys).select(*keys, AT, *_taken(take))
    found = lookup_join(complete, resolved, [*keys, AT], hot_rows=hot_rows, broadcast_rows=broadcast_rows)
    return found.select(*rows.columns, *take).unionByName(rest)


def _taken(take: Sequence[str]) -> list:
    """The columns of the carried version where it is still valid."""
    ends = F.col(VERSION)["__end"]
    still = ends.isNull() | (F.col(AT) < ends)
    return [F.when(still, F.col(VERSION)["taken"][c]).alias(c) for c in take]


def _carried_across_chunks(both: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The points with the last version before them, within their chunk or from the chunks before it."""
    parts = [*keys, CHUNK]
    window = Window.partitionBy(*parts).orderBy(AT, SIDE).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("__inside", F.last(VERSION, ignorenulls=True).over(window)).filter(F.col(SIDE) == 1)
    last = F.max_by(VERSION, F.when(F.col(SIDE) == 0, F.col(AT))).alias("__closing")
    across = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    edges = both.groupBy(*parts).agg(last).withColumn("__edge", F.last("__closing", ignorenulls=True).over(across))
    joined = inside.join(edges.select(*parts, "__edge"), parts, "left")
    return joined.withColumn(VERSION, F.coalesce("__inside", "__edge"))
