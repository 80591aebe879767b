"""Incremental pickup of a landing folder: every landed file is merged once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakestar.contracts import Contract
from lakestar.plans.silver import stage_latest
from lakestar.sources.files import matching_paths
from lakestar.sources.landing import (
    CORRUPT, CSV_READ_OPTIONS, PROBLEM, SOURCE_FILE, SUCCESS, file_glob, with_problem, with_source_file,
)
from lakestar.sources.tables import scd2_merge, table_exists, table_overwrite, table_read

BATCH = "batch"


def stream_landing(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    table_path: str,
    checkpoint: str,
    as_of: datetime,
    files_per_batch: int = 1000,
) -> dict[str, int]:
    """Merge all CSV files that arrived since the last run into a type 2 table.

    The stream picks files up, each once, and stores their checked rows by batch; its checkpoint
    remembers the files already taken. Once it has stopped, the newest row of every key among the batches
    not merged yet is merged at ``as_of``, so ``files_per_batch`` bounds the work of a batch and has no
    influence on the result. A run that stops in between is repaired by the next one, since merging rows
    twice changes nothing. A row older than the current version of its key is late and dropped. Records
    that do not parse and rows without a key are not merged; `picked_up` returns them.

    Returns the counts of inserted and expired versions and of the rows set aside.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{_picked(checkpoint)}/{BATCH}={batch_id}")

    schema = contract.text_schema().add(CORRUPT, "string")
    stream = (
        spark.readStream.schema(schema)
        .options(**CSV_READ_OPTIONS)
        .option("multiLine", "true")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob("csv"))
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    checked = with_problem(with_source_file(stream), contract)
    checked.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    merged_path = f"{checkpoint}/merged"
    merged = table_read(spark, merged_path).first()[BATCH] if table_exists(spark, merged_path) else -1
    if not matching_paths(spark, f"{_picked(checkpoint)}/{BATCH}=*/{SUCCESS}"):
        return {"inserted": 0, "expired": 0, "rejected": 0}
    rows = picked_up(spark, checkpoint, checked.schema).filter(F.col(BATCH) > merged)
    set_aside = F.col(PROBLEM).isin("no key", "corrupt")
    last = rows.agg(F.max(BATCH).alias(BATCH), F.count_if(set_aside).alias("rejected")).first()
    if last[BATCH] is None:
        return {"inserted": 0, "expired": 0, "rejected": 0}
    staged = stage_latest(rows.filter(~set_aside).select(*contract.columns, SOURCE_FILE), contract)
    counts = scd2_merge(staged, table_path, contract.keys, as_of, event_time="extraction_date")
    table_overwrite(spark.range(1).select(F.lit(last[BATCH]).alias(BATCH)), merged_path)
    return {**counts, "rejected": last["rejected"]}


def _picked(checkpoint: str) -> str:
    return f"{checkpoint}/picked"


def picked_up(spark: SparkSession, checkpoint: str, schema: StructType | None = None) -> DataFrame:
    """All rows that the runs of a stream picked up, with their batch and what is wrong with them."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField(BATCH, LongType())]))
    return reader.parquet(_picked(checkpoint))
