"""Stored profiles of a table's partitions: a run profiles only partitions whose files have changed."""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.sketches import PROFILE, merge_profiles, mergeable_profile
from lakestar.sources.files import delete_folder, matching_paths
from lakestar.sources.tables import replace_partition

# Fixed value: the folder name of the null partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def _partitions(spark: SparkSession, path: str, partition: str) -> dict[str, str]:
    """Folder names of the partitions with a digest of their files' names, which no two writes share."""
    files: dict[str, list[str]] = {}
    for file in matching_paths(spark, f"{path}/{partition}=*/*.parquet"):
        files.setdefault(file.getParent().getName(), []).append(file.getName())
    return {folder: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for folder, names in files.items()}


def stored_profiles(spark: SparkSession, profiles: str) -> DataFrame:
    """The profile of each partition, with its name and value as ``part`` and the digest of its files."""
    return spark.read.schema(f"{PROFILE}, files string, part string").parquet(profiles)


def refresh_profiles(spark: SparkSession, path: str, partition: str, profiles: str) -> list[str]:
    """Profile the new and changed partitions of a plain table, forget those that are gone; return what was read.

    All partitions that are read are profiled by one job. What passes through the driver is one name and digest
    per partition. A run that stops before its commit changes nothing and is repeated by the next.
    """
    present, known = _partitions(spark, path, partition), {}
    if matching_paths(spark, f"{profiles}/part=*"):
        known = dict(stored_profiles(spark, profiles).select("part", "files").distinct().collect())
    of = {unquote(folder): (folder, digest) for folder, digest in present.items()}
    for gone in known.keys() - of.keys():
        for folder in matching_paths(spark, f"{profiles}/part=*"):
            if unquote(folder.getName()[5:]) == gone:
                delete_folder(spark, folder.toString())
    changed = sorted(part for part, (_, digest) in of.items() if known.get(part) != digest)
    if not changed:
        return []
    before = spark.conf.get(INFERENCE)
    spark.conf.set(INFERENCE, "false")  # partitions are told apart by the texts of their folders
    try:
        rows = spark.read.option("basePath", path).parquet(*(f"{path}/{of[part][0]}" for part in changed))
    finally:
        spark.conf.set(INFERENCE, before)
    rows = rows.withColumn(partition, F.concat(F.lit(f"{partition}="), F.coalesce(partition, F.lit(NULL_PARTITION))))
    digests = spark.createDataFrame([(part, of[part][1]) for part in changed], "part string, files string")
    found = mergeable_profile(rows, [partition]).withColumnRenamed(partition, "part").join(digests, "part")
    replace_partition(found, profiles, "part")
    return changed


def table_profile_estimate(spark: SparkSession, profiles: str) -> DataFrame:
    """The merged profile of all partitions; no row of the table is read."""
    return merge_profiles(stored_profiles(spark, profiles))
