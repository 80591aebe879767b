"""Sinks: landed snapshots, clustered staging and document export."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.functions.dates import run_stamp
from lakestar.operators.quality import (
    drop_empty_rows, fill_timestamps, observe_counts, sanitize_timestamps,
)
from lakestar.session import settings
from lakestar.sources.landing import CSV_OPTIONS

# Files with quoted newlines are read by one task each, so they must not grow with the data.
ROWS_PER_FILE = 1_000_000
BUCKET = "bucket"
# Files that a task of the staging writes at a time, and the bytes that each of them buffers at most. Further
# buckets of a task are sorted.
OPEN_FILES = 16
BUFFER_BYTES = 16 * 1024 * 1024
# Ids, names and addresses are nearly as many as rows: a dictionary of them is built in vain, zstd finds what recurs.
PLAIN_ZSTD = {"compression": "zstd", "parquet.enable.dictionary": "false"}
# Text that is read once or twice: the level that costs a fraction of the default's time for a little more disk.
GZIP_LEVEL = {"zlib.compress.level": "BEST_SPEED"}


def land_snapshot(
    df: DataFrame, folder: str, entity: str, as_of: datetime, compression: str = "none"
) -> tuple[str, int]:
    """Write a stamped CSV snapshot of an entity; return its path and row count.

    A rerun of the same run replaces the snapshot. ``compression`` is ``none`` or ``gzip``; the readers take
    both, and files with quoted newlines are read whole in either case.
    """
    path = f"{folder}/{entity}/{entity}_{run_stamp(as_of)}"
    counted, df = observe_counts(df)
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS).option("compression", compression)
    writer.options(**GZIP_LEVEL).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)
    return path, counted.get["rows"]


def stage_clustered(
    df: DataFrame, folder: str, key: str, as_of: datetime, buckets: int = 10
) -> tuple[str, int]:
    """Write a stamped Parquet snapshot clustered by key; return its path and row count.

    Rows of one key share one of a fixed number of bucket folders; rows without a key belong to no
    cluster and are spread by their other values. Nothing is shuffled or, up to ``OPEN_FILES`` buckets, sorted:
    every task writes a file for each bucket that it has, all at a time, so a key with a third of all rows is
    written by all tasks. The scan's tasks are few for few rows and as large as its splits for many, and so are the files.
    """
    path = f"{folder}/repartitioned_{run_stamp(as_of)}"
    code = F.when(F.col(key).isNull(), F.hash(*df.columns)).otherwise(F.hash(key))
    bucketed = df.withColumn(BUCKET, F.pmod(code, F.lit(buckets)))
    counted, observed = observe_counts(bucketed)
    writer = observed.write.mode("overwrite").options(**PLAIN_ZSTD).option("parquet.block.size", BUFFER_BYTES)
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        writer.partitionBy(BUCKET).parquet(path)
    return path, counted.get["rows"]


def export_documents(
    df: DataFrame, path: str, as_of: datetime, fill: Sequence[str] = (), compression: str = "none"
) -> str:
    """Replace a document collection: one JSON document per row, null fields included.

    Timestamps before 1900 become null, nulls of the ``fill`` columns become the export time and
    rows without any value are dropped. ``compression`` is ``none`` or ``gzip``. Nothing passes through the driver.
    """
    documents = drop_empty_rows(fill_timestamps(sanitize_timestamps(df), fill, as_of))
    writer = documents.write.mode("overwrite").option("ignoreNullFields", "false")
    writer.options(**GZIP_LEVEL).option("compression", compression).json(path)
    return path
