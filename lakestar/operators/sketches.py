"""Profiles that can be merged: counts, distinct-count sketches and quantile sketches per part of a table.

Sketches are Spark's own aggregates of bounded size, so a profile is one pass with partial aggregation. Profiles
of parts merge into the profile of the whole without reading rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DateType, IntegerType, LongType, NumericType, StringType

# Log of the buckets of a distinct-count sketch (relative error of about 1.04 / sqrt(2 ** 12), 1.6 %), and the size
# of a quantile sketch (error in rank of about 1.3 %).
DISTINCT_BUCKETS, QUANTILE_SIZE = 12, 200
PROFILE = (
    "column_name string, data_type string, row_count long, null_count long, distinct_sketch binary, "
    "quantile_sketch binary"
)


def _countable(name: str, kind: DataType) -> Column:
    """The column in a type that distinct-count sketches take."""
    return F.col(name) if isinstance(kind, (IntegerType, LongType, StringType, BinaryType)) else F.col(name).cast("string")


def measured(name: str, kind: DataType) -> Column:
    """The column as the number that its quantiles are of: days since 1970 for dates, null for other types."""
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double") if isinstance(kind, NumericType) else F.lit(None).cast("double")


def mergeable_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` and other column: counts and sketches, see `PROFILE`.

    Nulls are counted and enter no sketch; a column without any value has an estimate of 0 and no quantiles.
    Numbers enter quantiles as doubles. Values of other types than integers, texts and binaries are counted
    by their texts. An empty table has no groups, so a profile by groups has no rows.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    totals = [F.count(F.lit(1)).alias("__rows")]
    for i, field in enumerate(fields):
        name = f"`{field.name}`"
        totals += [
            F.count_if(F.col(name).isNull()).alias(f"__null{i}"),
            F.hll_sketch_agg(_countable(name, field.dataType), DISTINCT_BUCKETS).alias(f"__distinct{i}"),
            F.kll_sketch_agg_double(measured(name, field.dataType), QUANTILE_SIZE).alias(f"__quantile{i}"),
        ]
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"), F.col(f"__null{i}").alias("null_count"),
            F.col(f"__distinct{i}").alias("distinct_sketch"), F.col(f"__quantile{i}").alias("quantile_sketch"))
        for i, f in enumerate(fields)
    ]
    return df.groupBy(*by).agg(*totals).select(*by, F.inline(F.array(*cells)))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of the rows of all profiles, per column name and type."""
    return profiles.groupBy("column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def profile_estimates(profile: DataFrame, quantiles: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Counts, ``distinct_estimate`` and ``quantiles`` of a profile; the first and the last quantile are exact."""
    ranks = F.array(*(F.lit(float(q)) for q in quantiles))
    filled = F.kll_sketch_get_n_double("quantile_sketch") > 0
    return profile.select(
        "column_name", "data_type", "row_count", "null_count",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.when(filled, F.kll_sketch_get_quantile_double("quantile_sketch", ranks)).alias("quantiles"))
