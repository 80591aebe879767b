"""Profiles, reconciliation, contract checks and clean-up of values.

Every report is one aggregate pass over the data; only its handful of result cells is unfolded into
rows afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from lakestar.contracts import Contract
from lakestar.operators.projection import as_column, canonicalize, misfit_columns, union_by_name

TIMESTAMPS = (TimestampType, TimestampNTZType)
OLDEST = "1900-01-01"

# Patterns of the added-date check, tested in this order.
URL_SHAPED = r"^(http|www\.)"
STARTS_WITH_YEAR = r"^\d{4}"
STARTS_WITH_DATE = r"^\d{4}-\d{2}-\d{2}"


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, null_count, row_count) for every column, in one pass."""
    totals = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns),
    )
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("null_count"),
            F.col("__rows").alias("row_count"),
        )
        for f in df.schema.fields
    ]
    return totals.select(F.inline(F.array(*cells)))


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`null_profile` of several tables, one after the other."""
    profiles = [
        null_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()
    ]
    return union_by_name(*profiles)


def observe_counts(df: DataFrame, **metrics: Column) -> tuple[Observation, DataFrame]:
    """Count rows, and any further aggregates, while the frame is written or aggregated.

    The observation holds ``rows`` and the named metrics after the first action on the returned
    frame, so no separate counting job is needed. Counts are exact where the returned frame is
    written as it is; below a later shuffle a lost executor can have rows counted again.
    """
    observation = Observation()
    observed = df.observe(
        observation, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in metrics.items())
    )
    return observation, observed


def reconcile_counts(original: DataFrame, saved: DataFrame) -> DataFrame:
    """One row (original_count, saved_count, counts_match) from one partial aggregate of both."""
    sides = [
        original.select(F.lit(1).alias("o"), F.lit(0).alias("s")),
        saved.select(F.lit(0).alias("o"), F.lit(1).alias("s")),
    ]
    totals = sides[0].unionAll(sides[1]).agg(
        F.count_if(F.col("o") == 1).alias("original_count"),
        F.count_if(F.col("s") == 1).alias("saved_count"),
    )
    return totals.withColumn("counts_match", F.col("original_count") == F.col("saved_count"))


def bad_values(df: DataFrame, column: str, ids: Sequence[str]) -> DataFrame:
    """Rows whose date text is unusable, with the value and the first reason that applies."""
    c = F.col(column)
    reason = (
        F.when(c.isNull(), "null")
        .when(c == "", "empty")
        .when(c.rlike(URL_SHAPED), "url")
        .when(~c.rlike(STARTS_WITH_YEAR), "no_year")
        .when(~c.rlike(STARTS_WITH_DATE), "no_iso_date")
    )
    return df.select(*ids, c, reason.alias("reason")).filter(F.col("reason").isNotNull())


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per declared or extra column: types, status, and how many values do not fit.

    Status is ``ok``, ``cast`` (present with another type), ``missing`` or ``extra``; ``required``
    marks the critical columns.
    """
    df = canonicalize(df, contract.renames)
    declared = {f.name: f.dataType for f in contract.schema.fields}
    actual = {f.name: f.dataType for f in df.schema.fields}
    checks = {name: F.count_if(wrong) for name, wrong in misfit_columns(df, contract).items()}
    totals = df.agg(
        F.count(F.lit(1)).alias("__rows"), *(check.alias(name) for name, check in checks.items())
    )
    cells = []
    for name in [*declared, *(n for n in actual if n not in declared)]:
        if name not in declared:
            status = "extra"
        elif name not in actual:
            status = "missing"
        else:
            status = "ok" if actual[name] == declared[name] else "cast"
        cells.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(declared[name].simpleString() if name in declared else None).cast("string").alias("expected_type"),
            F.lit(actual[name].simpleString() if name in actual else None).cast("string").alias("actual_type"),
            F.lit(status).alias("status"),
            F.lit(name in contract.required).alias("required"),
            (F.col(name) if name in checks else F.lit(0).cast("bigint")).alias("misfits"),
            F.col("__rows").alias("row_count"),
        ))
    return totals.select(F.inline(F.array(*cells)))


def missing_required(df: DataFrame, contract: Contract) -> list[str]:
    """Critical columns that the frame lacks."""
    present = canonicalize(df, contract.renames).columns
    return [c for c in contract.required if c not in present]


def timestamp_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TIMESTAMPS)]


def sanitize_timestamps(df: DataFrame, oldest: str = OLDEST) -> DataFrame:
    """Make every timestamp before ``oldest`` null, in all timestamp columns."""
    return df.withColumns({
        c: F.when(F.col(c) >= F.lit(oldest).cast(df.schema[c].dataType), F.col(c))
        for c in timestamp_columns(df)
    })


def fill_timestamps(df: DataFrame, columns: Sequence[str], value: object) -> DataFrame:
    """Replace nulls in the named timestamp columns only; an open ``valid_to`` has to stay null."""
    filled = as_column(value)
    return df.withColumns({
        c: F.coalesce(F.col(c), filled.cast(df.schema[c].dataType)) for c in columns
    })


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null."""
    return df.na.drop(how="all")


def extract_summary(entities: Mapping[str, DataFrame]) -> DataFrame:
    """(entity, entity_count) per extracted entity."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("entity_count")).select(F.lit(name).alias("entity"), "entity_count")
        for name, df in entities.items()
    ]
    return union_by_name(*counts)
