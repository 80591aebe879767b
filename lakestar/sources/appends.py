"""Insert-only tables that keep a key filter per append, so that a load opens only the appends it may meet.

``appends/v=<n>`` holds the rows of the n-th load and ``filters/v=<n>`` its filter, which is written after the rows
are committed. An append whose filter is missing gets one before the next load. There is one writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lakestar.operators.keyfilter import FILTER, block_count, filter_hits, key_filter
from lakestar.operators.quality import observe_counts
from lakestar.operators.scd import insert_new_only
from lakestar.sources.files import delete_folder
from lakestar.sources.tables import versions_of, with_columns_of

BITS_PER_KEY = 16


def appends_read(spark: SparkSession, path: str, numbers: Sequence[int] | None = None) -> DataFrame:
    """The rows of all complete appends, or of some."""
    numbers = versions_of(spark, f"{path}/appends") if numbers is None else numbers
    return spark.read.parquet(*(f"{path}/appends/v={n}" for n in numbers))


def _write_filter(spark: SparkSession, path: str, number: int, keys: Sequence[str], bits_per_key: int) -> None:
    rows = appends_read(spark, path, [number])
    blocks = block_count(rows.count(), bits_per_key)
    found = key_filter(rows, keys, blocks).select(
        F.lit(number).alias("append"), F.lit(blocks).cast("long").alias("blocks"), "*")
    found.write.mode("overwrite").parquet(f"{path}/filters/v={number}")


def insert_filtered(
    staged: DataFrame, path: str, keys: Sequence[str], bits_per_key: int = BITS_PER_KEY
) -> dict[str, int]:
    """Append the staged rows whose key no append has; the same rows as `insert_new_only` over the whole table.

    Staged keys are looked up in the filters; only appends with a hit are opened, and of those only the keys that
    hit are compared. Returns the ``inserted`` rows, the number of ``appends`` before and of those ``opened``. Rows
    with a null in the key are always inserted, as are staged rows that repeat a new key. Staged columns are taken
    in the types of the table; other columns than the table's fail. A load that stops is repeated by a rerun,
    which adds nothing twice; a load without new rows leaves no append. Keys of floating point are refused,
    since equal ones can differ in their bits.
    """
    spark = staged.sparkSession
    numbers = versions_of(spark, f"{path}/appends")
    opened: list[int] = []
    if numbers:
        stored = appends_read(spark, path, numbers[:1]).schema
        if {c.lower() for c in staged.columns} != {c.lower() for c in stored.names}:
            raise ValueError(f"columns {staged.columns} differ from the table's {stored.names}")
        staged = with_columns_of(staged, stored)
    if any(isinstance(staged.schema[k].dataType, (FloatType, DoubleType)) for k in keys):
        raise TypeError("keys of floating point have no filter")
    fresh, hits_path, following = staged, f"{path}/hits", max(numbers, default=0) + 1
    if numbers:
        for number in set(numbers) - set(versions_of(spark, f"{path}/filters")):
            _write_filter(spark, path, number, keys, bits_per_key)
        filters = spark.read.schema(FILTER).parquet(*(f"{path}/filters/v={n}" for n in numbers))
        sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]
        hits = filter_hits(staged, keys, filters, sizes)
        hits.write.mode("overwrite").parquet(hits_path)
        hits = spark.read.schema(hits.schema).parquet(hits_path)
        opened = sorted(r["__append"] for r in hits.select("__append").distinct().collect())
        if opened:
            met = hits.select(*keys).distinct()
            present = appends_read(spark, path, opened).select(*keys).join(met, list(keys), "left_semi")
            fresh = insert_new_only(present, staged, keys)
    counted, fresh = observe_counts(fresh)
    fresh.write.mode("overwrite").parquet(f"{path}/appends/v={following}")
    inserted = counted.get["rows"]
    if inserted or not numbers:
        _write_filter(spark, path, following, keys, bits_per_key)
    else:
        delete_folder(spark, f"{path}/appends/v={following}")
    delete_folder(spark, hits_path)
    return {"inserted": inserted, "appends": len(numbers), "opened": len(opened)}
