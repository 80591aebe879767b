"""Stored tables on plain Parquet.

Three layouts, each published by Spark's own job commit:

* versioned (``v=<n>/``): a table that is replaced as a whole. A version exists once its job has
  written ``_SUCCESS``; readers take the newest such version, so a failed or running write is never
  seen and a plan may read the table it is about to replace.
* type 2 (``current/v=<n>/`` and ``history/v=<n>/``): a merge rewrites the current versions and adds
  the expired ones to the history. History counts up to the newest current version, so both become
  visible together.
* plain Parquet: insert-only tables grow by appends, fact tables by replaced partitions.

There is one writer per table; nothing here arbitrates between concurrent writers.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType,
)

from lakestar.operators.projection import current_rows
from lakestar.operators.quality import observe_counts
from lakestar.operators.scd import changed_or_new, expire, insert_new_only, scd2_initial, with_hash
from lakestar.sources.files import delete_folder, matching_paths
from lakestar.sources.landing import SUCCESS

# Versions that stay after a publish: the new one, and the one that running readers still use.
KEEP = 2
# Hashes in hexadecimal digits take half the bytes of Spark's default, which codes no entropy.
COMPRESSION = "zstd"


def versions_of(spark: SparkSession, path: str) -> list[int]:
    """Complete versions below a folder, oldest first."""
    return sorted(int(p.getParent().getName()[2:]) for p in matching_paths(spark, f"{path}/v=*/{SUCCESS}"))


def _is_plain(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds committed files or partitions of a plain table.

    Replacing partitions leaves no ``_SUCCESS`` behind, but moves files in only when it commits.
    """
    names = (p.getName() for p in matching_paths(spark, f"{path}/*"))
    layout = ("current", "history", "delta")
    return any(n[0] not in "_." and not n.startswith("v=") and n not in layout for n in names)


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest complete version of a versioned folder; 0 when there is none."""
    return max(versions_of(spark, path), default=0)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete table of any layout is stored at the path."""
    return (
        latest_version(spark, f"{path}/current") > 0
        or latest_version(spark, path) > 0
        or _is_plain(spark, path)
    )


def table_read(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of a table of any layout."""
    current = latest_version(spark, f"{path}/current")
    if current:
        return _read_scd2(spark, path, current)
    version = latest_version(spark, path)
    return spark.read.parquet(f"{path}/v={version}" if version else path)


def table_overwrite(df: DataFrame, path: str, keep: int = KEEP) -> int:
    """Replace a table by a new version and return its number; the plan may read the old one."""
    version = latest_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/v={version}")
    drop_old_versions(df.sparkSession, path, keep)
    return version


def table_append(df: DataFrame, path: str) -> int:
    """Append rows to a plain table and return how many; counted during the write itself."""
    counted, df = observe_counts(df)
    df.write.mode("append").option("compression", COMPRESSION).parquet(path)
    return counted.get["rows"]


def table_insert_new(staged: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Append the staged rows whose key the table lacks; a rerun adds nothing."""
    spark = staged.sparkSession
    if table_exists(spark, path):
        staged = insert_new_only(table_read(spark, path), staged, keys)
    return table_append(staged, path)


def replace_partition(df: DataFrame, path: str, partition: str, values: Sequence[int | str] = ()) -> int:
    """Replace the partitions that occur in the frame, in one commit; return its rows.

    Partitions of the named ``values`` are replaced even if the frame has no row for them: those are
    then deleted.
    """
    counted, df = observe_counts(
        df, **{f"of_{i}": F.count_if(F.col(partition) == F.lit(v)) for i, v in enumerate(values)})
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", COMPRESSION).partitionBy(partition).parquet(path)
    for i, value in enumerate(values):
        if not counted.get[f"of_{i}"]:
            delete_folder(df.sparkSession, f"{path}/{partition}={value}")
    return counted.get["rows"]


def _read_scd2(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Current versions and history, read under the schema of the current ones: what it lacks is null."""
    current = spark.read.parquet(f"{path}/current/v={version}")
    if version == 1:
        return current
    if "v" in (c.lower() for c in current.columns):
        # A data column of the partition's name: the folders are read one by one, without partition columns.
        parts = [f"{path}/history/v={n}" for n in versions_of(spark, f"{path}/history") if n <= version]
        return current.unionByName(spark.read.schema(current.schema).parquet(*parts))
    schema = StructType([*current.schema.fields, StructField("v", IntegerType())])
    history = spark.read.schema(schema).parquet(f"{path}/history")
    return current.unionByName(history.filter(F.col("v") <= version).drop("v"))


# Types that hold every value of those named with them.
WIDER: dict[type[DataType], tuple[type[DataType], ...]] = {
    ShortType: (ByteType,), IntegerType: (ByteType, ShortType), LongType: (ByteType, ShortType, IntegerType),
    DoubleType: (FloatType, ByteType, ShortType, IntegerType),
}


def grown_columns(stored: StructType, staged: StructType) -> list[StructField]:
    """The staged columns that a stored table lacks, by names that differ in more than case.

    A column of both whose staged type is neither the stored one nor fits into it fails: values would be
    changed or lost.
    """
    have = {f.name.lower(): f for f in stored.fields}
    for field in staged.fields:
        old = have.get(field.name.lower())
        if old is None or old.dataType == field.dataType or isinstance(field.dataType, WIDER.get(type(old.dataType), ())):
            continue
        if old.dataType.simpleString() != field.dataType.simpleString():  # apart from nullability inside
            raise TypeError(f"column {field.name}: staged as {field.dataType.simpleString()}, "
                            f"stored as {old.dataType.simpleString()}")
    return [f for f in staged.fields if f.name.lower() not in have]


def with_columns_of(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame in the types and the order of a schema; columns that it lacks are null."""
    have = {c.lower() for c in df.columns}
    return df.select(*(
        (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def scd2_merge(
    staged: DataFrame,
    path: str,
    keys: Sequence[str],
    as_of: datetime,
    event_time: str | None = None,
    columns: Sequence[str] | None = None,
    keep: int = KEEP,
    tracked: Sequence[str] | None = None,
) -> dict[str, int]:
    """Apply a stage (one row per key, with hash) to a stored type 2 table.

    The changed or new rows are written first. They are few next to the table, and as a stored table
    their size is known, so Spark broadcasts them where that pays and the current versions are
    neither shuffled nor compared twice. Without changes nothing is published. ``columns`` fixes the
    column order of a new table. Returns the counts of inserted and expired versions, taken during
    the writes. ``as_of`` has to lie after the start of every version that it closes; otherwise the
    merge fails and publishes nothing.

    A stage may bring columns that the table lacks. The published version then has them after the stored
    ones, and older versions read null. A new column enters the stage's hash, so that by itself every row
    would count as changed; with ``tracked``, the columns of the hash in their order, the stored side is
    hashed anew and only rows with a value in a new column do. Stored columns that the stage lacks are null in
    the versions it opens; if they are in ``tracked``, the stage has to bring them. A type that does not fit
    the stored one fails and publishes nothing.
    """
    spark = staged.sparkSession
    version = latest_version(spark, f"{path}/current")
    if not version:
        first = scd2_initial(staged, as_of)
        inserted = _observed_write(first.select(*(columns or first.columns)), f"{path}/current/v=1")
        return {"inserted": inserted, "expired": 0}
    current = spark.read.parquet(f"{path}/current/v={version}")
    added = grown_columns(current.schema, staged.schema)
    schema = StructType([*current.schema.fields, *added])
    if added:
        current = with_columns_of(current, schema)
        if tracked is not None:
            current = with_hash(current, tracked).select(*schema.names)
    following = version + 1
    delta_path = f"{path}/delta/v={following}"
    delta = changed_or_new(current_rows(current), staged, keys, event_time)
    inserted = _observed_write(delta, delta_path)
    if not inserted:
        return {"inserted": 0, "expired": 0}
    delta = spark.read.schema(delta.schema).parquet(delta_path)
    replaced = current.join(delta.select(*keys), list(keys), "left_semi")
    expired = _observed_write(
        expire(replaced, as_of).select(*schema.names), f"{path}/history/v={following}"
    )
    kept = current.join(delta.select(*keys), list(keys), "left_anti")
    opened = with_columns_of(scd2_initial(delta, as_of), schema)
    kept.unionByName(opened).select(*schema.names).write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/current/v={following}")
    drop_old_versions(spark, f"{path}/current", keep)
    drop_old_versions(spark, f"{path}/delta", keep)
    return {"inserted": inserted, "expired": expired}


def _observed_write(df: DataFrame, path: str) -> int:
    counted, df = observe_counts(df)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return counted.get["rows"]


def drop_old_versions(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Delete all but the ``keep`` newest complete versions (0 keeps all); return how many went."""
    old = versions_of(spark, path)[:-keep] if keep else []
    for version in old:
        delete_folder(spark, f"{path}/v={version}")
    return len(old)
