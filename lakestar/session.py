"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE merges small shuffle partitions, splits skewed ones and turns a sort-merge join into a broadcast
# join once the measured size allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}
PARTITION_BYTES = 128 * 1024 * 1024
# Stored (compressed) bytes that one task reads where it sorts what it reads: few enough to sort in memory.
SORTED_SCAN_BYTES = 16 * 1024 * 1024
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
# Spark's own setting by which a finished query removes its shuffle files. Jobs whose frames run once each use it.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_held: dict[tuple[int, str], tuple[int, str | None]] = {}
_holding = threading.Lock()


def shuffle_partitions(shuffled_bytes: int, least: int = 200) -> int:
    """Partitions that keep each at about 128 MB; AQE merges them where less is shuffled.

    AQE splits skewed partitions only, so the count has to fit the largest shuffle beforehand.
    """
    return max(least, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    app: str = "lakestar", master: str | None = None, shuffled_bytes: int = 0, **conf: str
) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots.

    ``shuffled_bytes`` is the size of the largest table that a job shuffles.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(shuffled_bytes))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run a block under session settings; the last of overlapping blocks puts the earlier values back."""
    with _holding:
        for key, value in values.items():
            users, before = _held.get((id(spark), key), (0, spark.conf.get(key, None)))
            _held[id(spark), key] = users + 1, before
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _holding:
            for key in values:
                users, before = _held.pop((id(spark), key))
                if users > 1:
                    _held[id(spark), key] = users - 1, before
                elif before is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before)


def small_scans(spark: SparkSession, most: int) -> dict[str, str]:
    """The setting by which a scan task reads at most so many stored bytes, or fewer if the session says so."""
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {SCAN_BYTES: str(min(now, most))}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` for written intermediate tables.

    Every executor must see the folder, so a cluster has to name a shared one. Only a local master
    falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "lakestar-scratch")
    return f"{root.rstrip('/')}/lakestar-{label}-{uuid.uuid4().hex}"
