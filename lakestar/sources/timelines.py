"""Stored type 2 histories by event time, into which changes may be merged in any order of arrival.

Layout below the table's folder, each part a folder per merge, complete once its job has written ``_SUCCESS``:

* ``open/v=<n>``: the current version of every key and the time of its last observation; the newest one is the
  state of the table, everything else counts up to its number;
* ``log/v=<n>``: closed versions, and observations that opened none but may open one when a late row arrives;
* ``replaced/v=<n>``: keys into whose past a late row fell. That merge has written their whole log anew, so
  older rows of the log no longer count for them.

A change later than all that is known of its key touches only the current version. A late one splits
an interval: the log of its key is folded again, no other key is read into the fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.history import OPENS, timeline
from lakestar.operators.joins import HOT_ROWS
from lakestar.operators.projection import split_null_keys
from lakestar.operators.quality import observe_counts
from lakestar.operators.scd import with_hash
from lakestar.sources.tables import KEEP, drop_old_versions, latest_version, versions_of

VALIDITY = ("is_current", "valid_from", "valid_to")
LAST, MERGE, LATE = "last_seen", "merged_by", "late"
RESERVED = (*VALIDITY, OPENS, LAST, MERGE, LATE, "hash_key")


def timeline_read(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all keys, as `scd2_history` of all merged changes would give them."""
    version = latest_version(spark, f"{path}/open")
    if not version:
        raise FileNotFoundError(f"no timeline at {path}")
    current = spark.read.parquet(f"{path}/open/v={version}").drop(LAST)
    keys = _keys_of(spark, path, version)
    log = _live_log(spark, path, keys, version)
    if log is None:
        return current
    return current.unionByName(log.filter(F.col(OPENS)).select(*current.columns))


def merge_changes(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    time: str,
    tiebreak: Sequence[str] = (),
    *,
    hot_rows: int = HOT_ROWS,
    keep: int = KEEP,
) -> dict[str, int]:
    """Merge a batch of changes, of any number and age per key, into a stored history.

    Whatever the order and the batches in which changes arrive, the state equals `scd2_history` of all of
    them with the same arguments; merging a batch twice changes nothing. Rows without a key or a time are left
    out. Returns the counts of such ``rejected`` rows, of the ``keys`` in the batch, of the ``late`` ones
    among them, and of the rows ``logged``: closed versions and observations that open none. All batches have
    the same columns; another set of columns or another type fails.

    A merge that stops in between leaves folders that no reader counts and that the next merge replaces.
    """
    spark = changes.sparkSession
    taken = [c for c in changes.columns if c in RESERVED]
    if taken:
        raise ValueError(f"columns {taken} are reserved")
    version = latest_version(spark, f"{path}/open")
    following = version + 1
    placed, keyless = split_null_keys(changes, [*keys, time])
    staged = with_hash(placed, tracked)
    columns = staged.columns
    rejected = keyless.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    span = staged.groupBy(*keys).agg(F.min(time).alias("__first"))
    if version:
        current = spark.read.parquet(f"{path}/open/v={version}")
        _same_columns(current.select(*(c for c in current.columns if c not in (*VALIDITY, LAST))), staged)
        span = span.join(current.select(*keys, LAST), list(keys), "left")
        touched = span.select(*keys, F.coalesce(F.col("__first") <= F.col(LAST), F.lit(False)).alias(LATE))
    else:
        touched = span.select(*keys, F.lit(False).alias(LATE))
    counted, observed = observe_counts(touched, late=F.count_if(LATE))
    observed.write.mode("overwrite").parquet(f"{path}/touched/v={following}")
    if not counted.get["rows"]:
        return {"rejected": rejected, "keys": 0, "late": 0, "logged": 0}
    touched = spark.read.schema(touched.schema).parquet(f"{path}/touched/v={following}")
    known = staged
    if version:
        known = known.unionByName(current.join(touched, list(keys), "left_semi").select(*columns))
        log = _live_log(spark, path, list(keys), version)
        if log is not None and counted.get["late"]:
            known = known.unionByName(log.join(touched.filter(LATE), list(keys), "left_semi").select(*columns))
    folded = timeline(known, keys, time, tiebreak, hot_rows=hot_rows)
    folded.write.mode("overwrite").parquet(f"{path}/folded/v={following}")
    folded = spark.read.schema(folded.schema).parquet(f"{path}/folded/v={following}")
    closed = folded.filter(~F.col("is_current")).withColumn(MERGE, F.lit(following))
    logged, observed = observe_counts(closed)
    observed.write.mode("overwrite").parquet(f"{path}/log/v={following}")
    replaced = touched.filter(LATE).select(*keys, F.lit(following).alias(MERGE))
    replaced.write.mode("overwrite").parquet(f"{path}/replaced/v={following}")
    seen = folded.groupBy(*keys).agg(F.max(time).alias(LAST))
    opened = folded.filter("is_current").join(seen, list(keys)).select(*columns, *VALIDITY, LAST)
    if version:
        opened = opened.unionByName(current.join(touched, list(keys), "left_anti"))
    opened.write.mode("overwrite").parquet(f"{path}/open/v={following}")
    for part in ("open", "touched", "folded"):
        drop_old_versions(spark, f"{path}/{part}", keep)
    return {"rejected": rejected, "keys": counted.get["rows"], "late": counted.get["late"], "logged": logged.get["rows"]}


def _same_columns(stored: DataFrame, staged: DataFrame) -> None:
    have, new = ({f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields} for df in (stored, staged))
    if have != new:
        raise TypeError(f"the changes' columns differ from the stored ones: {sorted(have ^ new)}")


def _keys_of(spark: SparkSession, path: str, version: int) -> list[str]:
    return [c for c in spark.read.parquet(f"{path}/replaced/v={version}").columns if c != MERGE]


def _read_parts(spark: SparkSession, path: str, part: str, version: int) -> DataFrame | None:
    """All folders of a part up to a merge, read under the schema of the newest."""
    numbers = [n for n in versions_of(spark, f"{path}/{part}") if n <= version]
    if not numbers:
        return None
    schema = spark.read.parquet(f"{path}/{part}/v={numbers[-1]}").schema
    return spark.read.schema(schema).parquet(*(f"{path}/{part}/v={n}" for n in numbers))


def _live_log(spark: SparkSession, path: str, keys: list[str], version: int) -> DataFrame | None:
    """The rows of the log that no later merge has replaced."""
    log = _read_parts(spark, path, "log", version)
    if log is None:
        return None
    replaced = _read_parts(spark, path, "replaced", version)
    latest = replaced.groupBy(*keys).agg(F.max(MERGE).alias("__replaced"))
    joined = log.join(latest, keys, "left")
    return joined.filter(F.col("__replaced").isNull() | (F.col(MERGE) >= F.col("__replaced"))).drop("__replaced")
