"""Names for the tables of a lake, for users who query it in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestar.contracts import TABLES, Contract
from lakestar.operators.projection import enforce_contract
from lakestar.plans.layout import Layout
from lakestar.sources.landing import read_csv_contract
from lakestar.sources.tables import table_exists, table_read

RAW_FOLDERS = {"raw_artists": "artists", "raw_albums": "albums", "raw_tracks": "songs"}


def read_table(spark: SparkSession, layout: Layout, contract: Contract) -> DataFrame:
    """The latest state of a declared table in its declared columns; empty if not loaded yet."""
    layer, _, entity = contract.name.partition("_")
    if layer == "raw":
        rows = read_csv_contract(spark, f"{layout.raw}/{RAW_FOLDERS[contract.name]}", contract)
        return enforce_contract(rows, contract)
    path = f"{layout.silver}/{entity}" if layer == "silver" else f"{layout.gold}/{contract.name}"
    if not table_exists(spark, path):
        return spark.createDataFrame([], contract.schema)
    return table_read(spark, path).select(*contract.columns)


def declare_lake(spark: SparkSession, layout: Layout) -> list[str]:
    """Declare a view per table over its latest state; call again after a load to move on."""
    for name, contract in TABLES.items():
        read_table(spark, layout, contract).createOrReplaceTempView(name)
    return list(TABLES)
