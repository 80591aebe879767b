"""Projections: contract enforcement, renames, audit columns, by-name unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakestar.contracts import Contract
from lakestar.functions.dates import parse_partial_date


def as_column(value: object) -> Column:
    """A column as it is, anything else as a literal.

    A datetime without a zone is one of the session's zone, whatever zone the driver runs in.
    """
    if isinstance(value, datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp")
    return value if isinstance(value, Column) else F.lit(value)


def _fitted(df: DataFrame, contract: Contract, name: str) -> Column:
    """A present column in its declared type; null where the value does not fit."""
    data_type = contract.schema[name].dataType
    if name in contract.dates and isinstance(df.schema[name].dataType, StringType):
        return parse_partial_date(name, data_type.simpleString())
    return F.col(name).try_cast(data_type)


def misfit_columns(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Whether a value does not fit, per declared column that is present with another type."""
    return {
        f.name: F.col(f.name).isNotNull() & _fitted(df, contract, f.name).isNull()
        for f in contract.schema.fields
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }


def misfits(df: DataFrame, contract: Contract) -> Column:
    """``name=value`` lines of the values of a row that do not fit their types; null if all fit."""
    found = [
        F.when(wrong, F.concat(F.lit(f"{name}="), F.col(name).cast("string")))
        for name, wrong in misfit_columns(df, contract).items()
    ]
    return F.nullif(F.concat_ws("\n", *found), F.lit("")) if found else F.lit(None).cast("string")


def enforce_contract(df: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared types in the declared order; drop extras except ``keep``.

    A value that does not fit its type becomes null and is counted by `contract_report`. A column
    the source lacks becomes a typed null, but a missing key column is an error.
    """
    df = canonicalize(df, contract.renames)
    absent = [k for k in contract.keys if k not in df.columns]
    if absent:
        raise ValueError(f"{contract.name}: key columns {absent} are missing")
    projected = []
    for f in contract.schema.fields:
        if f.name not in df.columns:
            value = F.lit(None).cast(f.dataType)
        else:
            value = _fitted(df, contract, f.name)
        projected.append(value.alias(f.name))
    return df.select(*projected, *keep)


def canonicalize(
    df: DataFrame, renames: Mapping[str, str], copies: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename columns that are present, then add copies as ``{new name: existing column}``."""
    df = df.withColumnsRenamed({old: new for old, new in renames.items() if new not in df.columns})
    if copies:
        df = df.withColumns({new: F.col(existing) for new, existing in copies.items()})
    return df


def stamp_audit(
    df: DataFrame, as_of: datetime | Column, source_system: str, **constants: object
) -> DataFrame:
    """Add the source system, the load time and any constant columns."""
    columns = {"source_system": F.lit(source_system), "last_updated": as_column(as_of)}
    columns.update({name: as_column(value) for name, value in constants.items()})
    return df.withColumns(columns)


def with_default_column(df: DataFrame, name: str, value: object) -> DataFrame:
    """Add a column only where the frame does not have it."""
    return df if name in df.columns else df.withColumn(name, as_column(value))


def current_rows(df: DataFrame) -> DataFrame:
    """The current version of every entity."""
    return df.filter(F.col("is_current"))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows to quarantine).

    A null key never equals a stored key, so such a row would be inserted again by every run.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(complete), df.filter(~complete)
