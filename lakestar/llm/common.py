"""Small helpers of the operators: reading, written intermediate tables, size-checked joins, words."""

from __future__ import annotations

import ctypes
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestar.operators.joins import count_rows
from lakestar.session import scratch_dir

# A table of narrow rows (at most about 50 bytes each) is broadcast up to this counted number of rows.
BROADCAST_ROWS = 500_000
# Spark's own setting by which a finished query removes its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of one given table."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: lineage ends there and no executor is needed later.

    The shuffle files behind the table are removed once it is written, so a chain of stored tables holds the
    shuffles of one of its steps at a time.
    """
    spark = df.sparkSession
    path, before = scratch_dir(spark, label), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it as long as the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def widened(df: DataFrame, fields: str) -> StructType:
    """The schema of a DataFrame with further fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(fields).fields])


def open_file(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a file in the shared folder, for tasks."""
    return pafs.FileSystem.from_uri(uri)


def release_memory() -> None:
    """Give memory that a task has freed back to the system, as workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def narrow_join(df: DataFrame, narrow: DataFrame, on: Sequence[str] | Column, how: str) -> DataFrame:
    """Join with a stored table of narrow rows: broadcast when its counted rows are few, else by shuffle.

    Both forms give the same rows. A hot key of the shuffled form is split by adaptive execution.
    """
    if count_rows(narrow) <= BROADCAST_ROWS:
        narrow = F.broadcast(narrow)
    return df.join(narrow, on, how)


def without_rows(df: DataFrame, dropped: DataFrame, pairs: dict[str, Column]) -> DataFrame:
    """The rows of ``df`` whose keys are in no row of ``dropped``; nulls equal nulls.

    ``pairs`` maps each key column of ``dropped`` to an expression over ``df``.
    """
    renamed = dropped.select(*[F.col(k).alias(f"__dropped_{k}") for k in pairs])
    on = None
    for key, value in pairs.items():
        equal = value.eqNullSafe(F.col(f"__dropped_{key}"))
        on = equal if on is None else on & equal
    return narrow_join(df, renamed, on, "left_anti")
