"""Tables stored in hash buckets of their key, so that loads join without shuffling what is stored.

A table is laid out as Spark's own bucketed Parquet: rows of one key lie in one bucket, files name their bucket, and
a scan under the declared layout counts as partitioned by the key. So a load shuffles the staged side once, into as
many partitions as the table has buckets, and every step after that finds both sides in place.

``current/v=<n>`` and ``history/v=<n>`` are versions as in `tables`; an insert-only table has ``current/v=<n>`` only,
one per load. The layout is declared in the session's catalog when a version is read or written, under a
name that follows from its path, so any session can read what another one wrote. There is one writer per table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestar.operators.projection import current_rows
from lakestar.operators.quality import observe_counts
from lakestar.operators.scd import changed_or_new, expire, insert_new_only, scd2_initial
from lakestar.sources.files import delete_folder
from lakestar.sources.tables import KEEP, drop_old_versions, latest_version, versions_of, with_columns_of


@dataclass(frozen=True)
class Buckets:
    """The key columns of a table and the number of its buckets, which stay for its lifetime.

    A bucket is the work of one task: size the number for the table that is to come, at some 128 MB each.
    """

    keys: tuple[str, ...]
    count: int

    def __post_init__(self) -> None:
        if not self.keys or self.count < 1:
            raise ValueError("buckets need a key and a positive number")


def _name(path: str) -> str:
    return f"lakestar_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read_part(spark: SparkSession, path: str, buckets: Buckets) -> DataFrame:
    """One written folder, declared with its buckets unless the session knows it already."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(
            f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        keys = ", ".join(map(_quoted, buckets.keys))
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets.count} BUCKETS LOCATION '{location}'")
    return spark.table(name)


def _write_part(df: DataFrame, path: str, buckets: Buckets) -> int:
    """Write a folder in buckets and return its rows, counted during the write.

    Each task writes the buckets it holds; a frame that is partitioned by them makes a file per bucket.
    """
    counted, df = observe_counts(df)
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets.count, *buckets.keys).sortBy(*buckets.keys).saveAsTable(_name(path))
    return counted.get["rows"]


def _drop_part(spark: SparkSession, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    delete_folder(spark, path)


def _checked(staged: DataFrame, buckets: Buckets) -> DataFrame:
    """The stage; the job fails at a row whose key has a null, which would be new in every load."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in buckets.keys])
    return staged.filter(F.when(complete, F.lit(True)).otherwise(F.raise_error(F.lit("a staged key is null"))))


def _same_layout(spark: SparkSession, path: str, buckets: Buckets) -> None:
    """Write the layout of a new table beside it, or compare it with the one that is there."""
    layout = f"{path}/layout"
    row = spark.createDataFrame([(list(buckets.keys), buckets.count)], "keys array<string>, count int")
    if not latest_version(spark, layout):
        row.coalesce(1).write.mode("overwrite").parquet(f"{layout}/v=1")
        return
    known = spark.read.schema(row.schema).parquet(f"{layout}/v=1").first()
    if (tuple(known["keys"]), known["count"]) != (buckets.keys, buckets.count):
        raise ValueError(f"the table has {known['count']} buckets by {known['keys']}")


def copartitioned_read(spark: SparkSession, path: str, buckets: Buckets) -> DataFrame:
    """All rows of a stored table: current versions and history, or all loads of an insert-only table.

    Joins and groupings by the table's key over a single part need no exchange; see `copartitioned_current`.
    """
    _same_layout(spark, path, buckets)
    version = latest_version(spark, f"{path}/current")
    if not version:
        raise FileNotFoundError(f"no complete table at {path}")
    if latest_version(spark, f"{path}/inserted"):
        numbers = versions_of(spark, f"{path}/current")
        parts = [_read_part(spark, f"{path}/current/v={n}", buckets) for n in numbers]
    else:
        parts = [_read_part(spark, f"{path}/current/v={version}", buckets)]
        parts += [_read_part(spark, f"{path}/history/v={n}", buckets)
                  for n in versions_of(spark, f"{path}/history") if n <= version]
    return reduce(DataFrame.unionByName, parts)


def copartitioned_current(spark: SparkSession, path: str, buckets: Buckets) -> DataFrame:
    """The current versions of a stored type 2 table, as one scan that is partitioned by the key."""
    _same_layout(spark, path, buckets)
    version = latest_version(spark, f"{path}/current")
    if not version:
        raise FileNotFoundError(f"no complete table at {path}")
    return _read_part(spark, f"{path}/current/v={version}", buckets)


def copartitioned_merge(
    staged: DataFrame, path: str, buckets: Buckets, as_of: datetime, event_time: str | None = None, keep: int = KEEP
) -> dict[str, int]:
    """Apply a stage (one row per key, with hash) to a stored type 2 table, as `tables.scd2_merge` does.

    The stage is shuffled once, to the buckets. Changed and new rows are written in buckets, and from then on
    the versions they replace, the rows that stay and the next current state come from bucket-wise joins
    without an exchange, however large both sides are; Spark still broadcasts a side that is measured to be small.
    The stage has to bring the table's columns; they are taken in its types. A null in a key fails, as does an
    ``as_of`` that does not lie after the start of every version that it closes; nothing is published then.
    An empty stage and a repeated one publish nothing. Returns the counts of inserted and expired versions.
    """
    spark = staged.sparkSession
    _same_layout(spark, path, buckets)
    version, keys = latest_version(spark, f"{path}/current"), list(buckets.keys)
    staged = _checked(staged, buckets).repartition(buckets.count, *keys)
    if not version:
        inserted = _write_part(scd2_initial(staged, as_of), f"{path}/current/v=1", buckets)
        return {"inserted": inserted, "expired": 0}
    following = version + 1
    current = _read_part(spark, f"{path}/current/v={version}", buckets)
    opened_columns = ("is_current", "valid_from", "valid_to")
    schema = StructType([f for f in current.schema.fields if f.name not in opened_columns])
    if {c.lower() for c in staged.columns} != {c.lower() for c in schema.names}:
        raise ValueError(f"columns {staged.columns} differ from the table's {schema.names}")
    delta_path, history_path = f"{path}/delta/v={following}", f"{path}/history/v={following}"
    found = changed_or_new(current_rows(current), with_columns_of(staged, schema), keys, event_time)
    inserted = _write_part(found, delta_path, buckets)
    if not inserted:
        _drop_part(spark, delta_path)
        return {"inserted": 0, "expired": 0}
    delta = _read_part(spark, delta_path, buckets)
    expired = _write_part(expired_versions(current, delta, keys, as_of), history_path, buckets)
    _write_part(next_current(current, delta, keys, as_of), f"{path}/current/v={following}", buckets)
    for folder in ("current", "delta"):
        for old in versions_of(spark, f"{path}/{folder}")[:-keep] if keep else []:
            spark.sql(f"DROP TABLE IF EXISTS {_name(f'{path}/{folder}/v={old}')}")
        drop_old_versions(spark, f"{path}/{folder}", keep)
    return {"inserted": inserted, "expired": expired}


def expired_versions(current: DataFrame, delta: DataFrame, keys: Sequence[str], as_of: datetime) -> DataFrame:
    """The versions that changed rows replace, closed."""
    return expire(current.join(delta.select(*keys), list(keys), "left_semi"), as_of).select(*current.columns)


def next_current(current: DataFrame, delta: DataFrame, keys: Sequence[str], as_of: datetime) -> DataFrame:
    """The current versions after a load: those without a change and the opened ones."""
    kept = current.join(delta.select(*keys), list(keys), "left_anti")
    opened = with_columns_of(scd2_initial(delta, as_of), current.schema)
    return kept.select(*current.columns).unionByName(opened)


def copartitioned_insert(staged: DataFrame, path: str, buckets: Buckets) -> int:
    """Add the staged rows (one per key) whose key the insert-only table lacks, as one more bucketed load.

    The stage is shuffled once; each earlier load is then compared bucket by bucket without an exchange. Rows
    that are stored never move. A repeated or empty load adds nothing; a null in a key fails. Returns the
    rows added.
    """
    spark = staged.sparkSession
    _same_layout(spark, path, buckets)
    numbers, keys = versions_of(spark, f"{path}/current"), list(buckets.keys)
    fresh = _checked(staged, buckets).repartition(buckets.count, *keys)
    if numbers:
        parts = [_read_part(spark, f"{path}/current/v={n}", buckets) for n in numbers]
        schema = parts[0].schema
        if {c.lower() for c in staged.columns} != {c.lower() for c in schema.names}:
            raise ValueError(f"columns {staged.columns} differ from the table's {schema.names}")
        fresh = new_rows(with_columns_of(fresh, schema), parts, keys)
    else:
        # Marks the table as one whose loads all count.
        spark.range(1).write.mode("overwrite").parquet(f"{path}/inserted/v=1")
    part = f"{path}/current/v={max(numbers, default=0) + 1}"
    added = _write_part(fresh, part, buckets)
    if numbers and not added:
        _drop_part(spark, part)
    return added


def new_rows(staged: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The staged rows whose key is in none of the parts."""
    return reduce(lambda rows, part: insert_new_only(part, rows, keys), parts, staged)
