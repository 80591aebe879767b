"""Slowly changing dimensions of type 2 and insert-only loads, as pure DataFrame functions.

Every function takes the load time ``as_of`` as an argument and stages hold one row per key (see
`dedup`), with a ``hash_key`` over the tracked columns. The old version ends exactly where the new
one starts, so the validity intervals of a key are half-open and leave no gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from lakestar.functions.hashing import row_hash
from lakestar.operators.projection import as_column, current_rows

HASH = "hash_key"


def with_hash(df: DataFrame, tracked: Sequence[str], name: str = HASH) -> DataFrame:
    """Add the change hash over the tracked columns.

    Instants enter as microseconds, so that the hash does not depend on the session's time zone.
    """
    values = (F.unix_micros(c) if isinstance(df.schema[c].dataType, TimestampType) else F.col(c) for c in tracked)
    return df.withColumn(name, row_hash(*values))


def scd2_initial(staged: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Open a first version for every staged row."""
    start = as_column(as_of)
    return staged.withColumns({
        "is_current": F.lit(True),
        "valid_from": start,
        "valid_to": F.when(F.lit(False), start),
    })


def _is_change(old_hash: Column, new_hash: Column, old_time: Column | None, new_time: Column | None) -> Column:
    """A differing hash, unless the staged row is older than the version it would replace."""
    changed = ~old_hash.eqNullSafe(new_hash)
    if old_time is not None and new_time is not None:
        changed = changed & ~F.coalesce(new_time < old_time, F.lit(False))
    return changed


def changed_or_new(
    current: DataFrame, staged: DataFrame, keys: Sequence[str], event_time: str | None = None
) -> DataFrame:
    """Staged rows whose key is unknown or whose hash differs from the current version.

    Only keys, hash and event time of the current side are read and shuffled.
    """
    known = {"__hash": F.col(HASH), "__known": F.lit(True)}
    if event_time:
        known["__time"] = F.col(event_time)
    known_rows = current.select(*keys, *(c.alias(name) for name, c in known.items()))
    change = _is_change(
        F.col("__hash"), F.col(HASH),
        F.col("__time") if event_time else None, F.col(event_time) if event_time else None,
    )
    joined = staged.join(known_rows, list(keys), "left")
    return joined.filter(F.col("__known").isNull() | change).select(*staged.columns)


def _ending(start: Column, end: Column) -> Column:
    """The end of a version; the job fails if it does not lie after its start."""
    wrong = F.raise_error(F.lit("as_of does not lie after the start of a version it would close"))
    return F.when(start < end, end).otherwise(wrong)


def expire(rows: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Close versions at the load time, which has to lie after their start."""
    end = as_column(as_of)
    ending = _ending(F.col("valid_from"), end).cast(rows.schema["valid_to"].dataType)
    closed = {"is_current": F.lit(False), "valid_to": ending}
    if "last_updated" in rows.columns:
        closed["last_updated"] = end.cast(rows.schema["last_updated"].dataType)
    return rows.withColumns(closed)


def scd2_apply(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    as_of: datetime | Column,
    event_time: str | None = None,
) -> DataFrame:
    """The next state of a dimension: history, kept and expired versions, and new versions.

    One full outer join of current versions and stage on the key, both unique there, pairs old and
    new; each pair then yields one or two rows. History rows skip the join. Keys missing from the
    stage stay current, and applying the same stage again changes nothing. With ``event_time`` a
    staged row older than the current version is dropped. ``as_of`` has to lie after the start of every
    version that it closes, or the job fails.
    """
    columns = target.columns
    opened = scd2_initial(staged, as_of)
    opened = opened.select(*(F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns))
    old = current_rows(target).select(*keys, F.struct(*columns).alias("old"))
    new = opened.select(*keys, F.struct(*columns).alias("new"))
    closed = F.col("old").withField("is_current", F.lit(False)).withField(
        "valid_to",
        _ending(F.col("old.valid_from"), as_column(as_of)).cast(target.schema["valid_to"].dataType),
    )
    if "last_updated" in columns:
        closed = closed.withField(
            "last_updated", as_column(as_of).cast(target.schema["last_updated"].dataType)
        )
    known, seen = F.col("old").isNotNull(), F.col("new").isNotNull()
    change = known & seen & _is_change(
        F.col(f"old.{HASH}"), F.col(f"new.{HASH}"),
        F.col(f"old.{event_time}") if event_time else None,
        F.col(f"new.{event_time}") if event_time else None,
    )
    kept = F.when(known, F.when(change, closed).otherwise(F.col("old")))
    added = F.when(~known | change, F.col("new"))
    paired = old.join(new, list(keys), "full")
    merged = paired.select(F.inline(F.array_compact(F.array(kept, added))))
    return target.filter(~F.col("is_current")).unionByName(merged)


def insert_new_only(existing: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows whose key does not exist yet; existing rows are never changed."""
    return staged.join(existing.select(*keys), list(keys), "left_anti").select(*staged.columns)
