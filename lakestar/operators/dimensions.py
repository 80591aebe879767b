"""Dimension rows of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.dates import date_key
from lakestar.functions.hashing import surrogate_key
from lakestar.operators.dedup import dedup_latest
from lakestar.operators.projection import canonicalize, current_rows, stamp_audit
from lakestar.operators.scd import scd2_initial


def date_spine(bounds: DataFrame, first: str | Column, last: str | Column, name: str = "calendar_date") -> DataFrame:
    """One row per day of the closed range from the earliest ``first`` to the latest ``last``.

    The bounds come from one aggregate, so the range can be taken from a column of a large table or
    from a single row of literals.
    """
    first = F.col(first) if isinstance(first, str) else first
    last = F.col(last) if isinstance(last, str) else last
    ends = bounds.agg(F.min(first.cast("date")).alias("d0"), F.max(last.cast("date")).alias("d1"))
    days = F.sequence(F.col("d0"), F.col("d1"), F.expr("interval 1 day"))
    return ends.select(F.explode(days).alias(name))


def date_dimension(days: DataFrame, day: str = "calendar_date") -> DataFrame:
    """Calendar attributes of every day; weeks are ISO weeks and the first weekday is Sunday."""
    d = F.col(day)
    return days.select(
        d.alias("calendar_date"),
        date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
    )


def dimension_scd2(
    silver: DataFrame,
    natural: str,
    key_name: str,
    source_system: str,
    as_of: datetime | Column,
    columns: Sequence[str],
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stage of a type 2 dimension: the current silver row of every entity with its durable key.

    Older silver versions are left out, so the stage has one row per key. ``columns`` are the
    dimension's columns; its three validity columns are set when the stage is applied.
    """
    rows = dedup_latest(current_rows(silver), [natural], ["valid_from"])
    rows = canonicalize(rows, renames or {})
    rows = rows.withColumn(key_name, surrogate_key(natural, source=source_system))
    rows = stamp_audit(rows, as_of, source_system)
    return rows.select(*(c for c in columns if c not in ("is_current", "valid_from", "valid_to")))


def dimension_insert_only(
    silver: DataFrame,
    natural: str,
    key_name: str,
    source_system: str,
    as_of: datetime | Column,
    columns: Sequence[str],
    copies: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of an insert-only dimension: durable key, open validity, audit columns."""
    rows = canonicalize(silver, {}, copies)
    rows = rows.withColumn(key_name, surrogate_key(natural, source=source_system))
    rows = scd2_initial(stamp_audit(rows, as_of, source_system), as_of)
    return rows.select(*columns)
