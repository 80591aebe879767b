"""Version history of a whole change log in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.operators.chunks import CHUNK, hot_counts, with_chunks
from lakestar.operators.dedup import one_per_key, orderable_columns
from lakestar.operators.joins import HOT_ROWS
from lakestar.operators.projection import split_null_keys
from lakestar.operators.scd import HASH, with_hash

OPENS = "opens"


def scd2_history(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    tiebreak: Sequence[str] = (),
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions that folding the changes through `scd2_apply` in time order would leave.

    The last row of a key at one time counts, by ascending ``tiebreak`` columns, then by the hash of the
    tracked values and all remaining columns, so neither the input's order nor its size changes a
    result; a row that repeats its predecessor's tracked values opens no version. Rows without a key or a
    time have no place in a history and belong in quarantine (see `split_null_keys`).

    Keys with fewer than ``hot_rows`` rows take one shuffle and one sort. Whether there are others
    is counted first. If so, every key and time is first reduced to its last row, of which map tasks send
    one each; one aggregate over the hot keys then cuts their times at quantiles into chunks of about
    ``hot_rows`` rows. Windows work within chunks, and one row per chunk carries the values across their
    edges. So no task holds a hot key, even if all of its rows share one time, and there is no bound on
    keys or chunks.
    """
    placed, _ = split_null_keys(changes, [*keys, time])
    prepared = with_hash(placed, tracked)
    rows = _opening(prepared, keys, time, tiebreak, hot_rows)
    return _versions(rows.filter(F.col(OPENS)), keys, time, prepared.columns)


def timeline(
    prepared: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str] = (), *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """`scd2_history` of rows with a hash and a complete key and time, with the rows that open no version.

    ``opens`` tells the versions from those; the latter have no validity.
    """
    rows = _opening(prepared, keys, time, tiebreak, hot_rows)
    versions = _versions(rows.filter(F.col(OPENS)), keys, time, prepared.columns).withColumn(OPENS, F.lit(True))
    repeats = rows.filter(~F.col(OPENS)).select(*prepared.columns, OPENS)
    return versions.unionByName(repeats.withColumn("is_current", F.lit(False)), allowMissingColumns=True)


def _opening(
    prepared: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str], hot_rows: int
) -> DataFrame:
    """The last row of each key and time, with ``opens`` and, of hot keys, a chunk and what follows it."""
    columns = prepared.columns
    last = [*tiebreak, HASH, *orderable_columns(prepared, [*keys, time, *tiebreak, HASH])]
    hot, n_hot, most = hot_counts(prepared, keys, hot_rows)
    if not n_hot:
        rows = _last_of_time(prepared, keys, time, [F.col(time).asc(), *(F.col(c).asc() for c in last)])
        return rows.withColumn(OPENS, ~F.col("__prev").eqNullSafe(F.col(HASH)))
    rows = one_per_key(prepared, [*keys, time], [F.col(c).desc() for c in last])
    rows = with_chunks(rows, keys, time, hot, n_hot, most, hot_rows)
    return _stitched(rows, keys, time, columns)


def _last_of_time(
    rows: DataFrame, parts: Sequence[str], time: str, order: Sequence[Column]
) -> DataFrame:
    """The last row of each part and time, with the hash of the row before it.

    The windows share one exchange and one sort: ordering by time is a prefix of the total order.
    """
    rows = rows.withColumn("__next", F.lead(time).over(Window.partitionBy(*parts).orderBy(*order)))
    rows = rows.filter(~F.col("__next").eqNullSafe(F.col(time)))
    return rows.withColumn("__prev", F.lag(HASH).over(Window.partitionBy(*parts).orderBy(time)))


def _stitched(rows: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str]) -> DataFrame:
    """Rows that carry a chunk and are unique by key and time: windows inside, one row per chunk across."""
    parts = [*keys, CHUNK]
    rows = rows.withColumn("__prev", F.lag(HASH).over(Window.partitionBy(*parts).orderBy(time)))
    inner = F.when(F.col("__prev").isNotNull() & (F.col("__prev") != F.col(HASH)), F.col(time))
    edges = rows.groupBy(*parts).agg(
        F.min(time).alias("__first"), F.min_by(HASH, time).alias("__opening"),
        F.max_by(HASH, time).alias("__closing"), F.min(inner).alias("__inner"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    edges = edges.withColumn("__edge", F.lag("__closing").over(across))
    changed = F.when(F.col("__edge").eqNullSafe(F.col("__opening")), F.col("__inner")).otherwise(F.col("__first"))
    # The next change after a chunk is the last one met when its key is walked backwards.
    following = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    opens = F.last("__change", ignorenulls=True).over(following)
    edges = edges.withColumn("__change", changed).withColumn("__following", opens).select(*parts, "__edge", "__following")
    rows = rows.join(edges, parts, "left")
    rows = rows.withColumn(OPENS, ~F.coalesce("__prev", "__edge").eqNullSafe(F.col(HASH)))
    return rows.select(*columns, CHUNK, "__following", OPENS)


def _versions(opening: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str]) -> DataFrame:
    """Validity of rows that each open a version."""
    if CHUNK in opening.columns:
        inside = F.lead(time).over(Window.partitionBy(*keys, CHUNK).orderBy(time))
        until = F.coalesce(inside, "__following")
    else:
        until = F.lead(time).over(Window.partitionBy(*keys).orderBy(time))
    return opening.withColumn("__until", until).select(
        *columns,
        F.col("__until").isNull().alias("is_current"),
        F.col(time).alias("valid_from"),
        F.col("__until").alias("valid_to"),
    )
