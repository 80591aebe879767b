"""The corpus pipeline: documents in, encoded clean documents out.

Each stage takes (spark, docs, sf_dir), works on every document that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from lakestar.llm.bpe import bpe_digests  # noqa: E402
from lakestar.llm.common import read_table, stored  # noqa: E402
from lakestar.llm.decontaminate import decontaminate  # noqa: E402
from lakestar.llm.exact_dedup import drop_exact_duplicates  # noqa: E402
from lakestar.llm.jaccard_join import drop_near_duplicates  # noqa: E402
from lakestar.llm.quality import keep_good  # noqa: E402
from lakestar.llm.queries import held_out_for_quality, in_first_snapshot  # noqa: E402


# Texts are long: with Spark's 10,000 rows a batch, buffers of 30 MB each are held several times by every task.
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def small_batches(spark: SparkSession) -> None:
    """Have the session hand at most ``BATCH_ROWS`` rows at a time to Python, or fewer if it says so.

    Spark reads the setting when a stage is written, which its caller does, so it stays set.
    """
    now = int(spark.conf.get(ARROW_ROWS, "10000"))
    spark.conf.set(ARROW_ROWS, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    small_batches(spark)
    return keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"), held_out_for_quality())


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    small_batches(spark)
    return drop_exact_duplicates(docs, in_first_snapshot())


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links by 0.8 of its five-word shingles."""
    small_batches(spark)
    return drop_near_duplicates(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    small_batches(spark)
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents encoded and decoded: counts and digests."""
    small_batches(spark)
    return bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

# The classifier and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
