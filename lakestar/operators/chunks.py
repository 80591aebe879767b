"""Cutting the rows of hot keys into chunks of time, so that a window never holds a whole hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.joins import MAX_HOT_KEYS

CHUNK, BOUNDS = "__chunk", "__bounds"
# Time bounds that are broadcast at most: hot keys times chunks per key.
BROADCAST_BOUNDS = 500_000


def hot_counts(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, int, int]:
    """(the largest keys with at least ``hot_rows`` rows, how many they are, the rows of the largest).

    At most `MAX_HOT_KEYS` keys, as in `hot_keys`: counted once here, not in every plan that uses them.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= hot_rows)
    found = counts.orderBy(F.desc("__n"), *keys).limit(MAX_HOT_KEYS).collect()
    hot = rows.sparkSession.createDataFrame([tuple(r)[:-1] for r in found], rows.select(*keys).schema)
    return hot, len(found), found[0]["__n"] if found else 0


def with_chunks(rows: DataFrame, keys: Sequence[str], time: str, hot: DataFrame, n_hot: int, most: int,
                hot_rows: int) -> DataFrame:
    """The rows with ``CHUNK``, a number that rises with time; 0 for all rows of other than hot keys.

    One aggregate over the rows of the hot keys alone cuts each of them at quantiles of time into chunks of
    about ``hot_rows`` rows. Rows of one key and time share a chunk, so rows should be unique by both.
    """
    chunks = max(2, -(-most // hot_rows))
    cuts = F.array(*[F.lit(i / chunks) for i in range(1, chunks)])
    some = rows.select(*keys, time).join(F.broadcast(hot), list(keys), "left_semi")
    bounds = some.groupBy(*keys).agg(F.percentile_approx(time, cuts, 20 * chunks).alias(BOUNDS))
    bounds = bounds.select(*keys, F.array_distinct(BOUNDS).alias(BOUNDS))
    if n_hot * chunks <= BROADCAST_BOUNDS:
        bounds = F.broadcast(bounds)
    passed = F.size(F.filter(BOUNDS, lambda bound: bound <= F.col(time)))
    return rows.join(bounds, list(keys), "left").withColumn(
        CHUNK, F.when(F.col(BOUNDS).isNull(), 0).otherwise(passed)).drop(BOUNDS)
