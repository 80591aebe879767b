"""Content reconciliation: checksums of multisets of rows, and the cells behind a difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lakestar.functions.hashing import row_hash
from lakestar.operators.quality import observe_counts

BUCKETS = 16
BUCKET, COUNT, CHECKSUM = "bucket", "n_rows", "checksum"


def _digest(columns: Sequence[str]) -> Column:
    """64 bits of the row's hash as a number, so that sums of it do not depend on the order of rows."""
    return F.conv(F.substring(row_hash(*columns), 1, 16), 16, 10).cast("decimal(38,0)")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in keys)), F.lit(buckets)).cast("int")


def bucket_checksums(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n_rows, checksum) of the rows, by a hash of their keys; a bucket without rows is absent.

    The checksum is the sum of a hash of each row: equal for equal multisets of rows, in any order, and
    different, up to chance, as soon as one cell differs or a row is there once more. Columns enter by name in
    sorted order and as text, so both sides should be in the same types.
    """
    hashed = df.select(_bucket(keys, buckets).alias(BUCKET), _digest(sorted(df.columns)).alias("digest"))
    return hashed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias(COUNT), F.sum("digest").alias(CHECKSUM))


def observed_checksums(
    df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> tuple[Observation, DataFrame]:
    """The frame, whose next write also takes the counts and checksums of `bucket_checksums`.

    Read them with `checksums_of` once the write is done. A sum per bucket is kept by every task, so the rows
    are neither read again nor shuffled.
    """
    digest, bucket = _digest(sorted(df.columns)), _bucket(keys, buckets)
    metrics = {}
    for i in range(buckets):
        metrics[f"n_{i}"] = F.count_if(bucket == i)
        metrics[f"s_{i}"] = F.sum(F.when(bucket == i, digest))
    return observe_counts(df, **metrics)


def checksums_of(spark, observation: Observation, buckets: int = BUCKETS) -> DataFrame:
    """`bucket_checksums` as an observed write has taken them."""
    found = observation.get
    rows = [(i, found[f"n_{i}"], found[f"s_{i}"]) for i in range(buckets) if found[f"n_{i}"]]
    return spark.createDataFrame(rows, f"{BUCKET} int, {COUNT} bigint, {CHECKSUM} decimal(38,0)")


def differing_buckets(original: DataFrame, saved: DataFrame) -> DataFrame:
    """(bucket, original_rows, saved_rows) of the buckets whose counts or checksums differ."""
    left = original.select(BUCKET, F.col(COUNT).alias("original_rows"), F.col(CHECKSUM).alias("o"))
    right = saved.select(BUCKET, F.col(COUNT).alias("saved_rows"), F.col(CHECKSUM).alias("s"))
    both = left.join(right, BUCKET, "full").filter(~F.col("o").eqNullSafe(F.col("s")) | ~F.col("original_rows").eqNullSafe(F.col("saved_rows")))
    return both.select(
        BUCKET, F.coalesce("original_rows", F.lit(0)).alias("original_rows"),
        F.coalesce("saved_rows", F.lit(0)).alias("saved_rows"))


def differing_cells(
    original: DataFrame, saved: DataFrame, keys: Sequence[str], only: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """(keys, kind, column_name, original, saved): what has to change to get from one side to the other.

    ``only`` names the buckets to look into (`differing_buckets`); others are left out before anything is
    shuffled. Rows that both sides hold equally often cancel out first, in one partial aggregate; the rest is
    paired by key, repeats of a key in the order of their values. A ``changed`` pair gives a row per differing
    column, with both values as text; a ``missing`` or ``added`` row gives one row without a column.
    """
    columns = sorted(original.columns)
    others = [c for c in columns if c not in keys]
    if sorted(saved.columns) != columns:
        raise ValueError(f"columns differ: {sorted(set(columns) ^ set(saved.columns))}")

    def side(df: DataFrame, sign: int) -> DataFrame:
        df = df.select(
            *(F.col(c) if c in keys else F.col(c).cast("string").alias(c) for c in columns), F.lit(sign).alias("sign"))
        if only is not None:
            df = df.withColumn(BUCKET, _bucket(keys, buckets)).join(F.broadcast(only.select(BUCKET)), BUCKET, "left_semi").drop(BUCKET)
        return df

    left_over = side(original, 1).unionByName(side(saved, -1)).groupBy(*columns).agg(F.sum("sign").alias("extra"))
    left_over = left_over.filter("extra <> 0").withColumn("side", F.signum("extra").cast("int"))
    left_over = left_over.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("extra")))).drop("extra")
    order = Window.partitionBy(*keys, "side").orderBy(*others, "copy")
    numbered = left_over.withColumn("number", F.row_number().over(order)).drop("copy")
    paired = numbered.groupBy(*keys, "number").agg(*(
        F.max(F.when(F.col("side") == s, F.struct("side", *others))).alias(name)
        for s, name in ((1, "o"), (-1, "s"))))
    cells = [
        F.when(~F.col("o")[c].eqNullSafe(F.col("s")[c]), F.struct(
            F.lit("changed").alias("kind"), F.lit(c).alias("column_name"),
            F.col("o")[c].alias("original"), F.col("s")[c].alias("saved"))) for c in others]
    none = F.lit(None).cast("string")
    alone = F.array(F.struct(
        F.when(F.col("s").isNull(), "missing").otherwise("added").alias("kind"), none.alias("column_name"),
        none.alias("original"), none.alias("saved")))
    either = reduce(lambda a, b: a | b, [F.col("o").isNull(), F.col("s").isNull()])
    found = F.when(either, alone).otherwise(F.array_compact(F.array(*cells))) if cells else alone
    return paired.select(*keys, F.inline(found))
