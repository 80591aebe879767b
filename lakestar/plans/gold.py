"""Gold job: dimensions, calendar, daily fact, document export and the analysis queries."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.contracts import DIM_ALBUMS, DIM_ARTISTS, DIM_TRACKS, FACT_TRACK_PLAYS, Contract
from lakestar.functions.dates import calendar_bounds, date_key, run_stamp
from lakestar.functions.hashing import surrogate_key
from lakestar.operators.dimensions import (
    date_dimension, date_spine, dimension_insert_only, dimension_scd2,
)
from lakestar.operators.facts import Lookup, snapshot_fact
from lakestar.operators.projection import current_rows
from lakestar.operators.quality import table_profile
from lakestar.operators.rankings import (
    avg_by_year, top_entities_by_avg, top_groups_by_count, top_groups_prelimit,
)
from lakestar.plans.layout import Layout, Metrics
from lakestar.session import DROP_SHUFFLES, SORTED_SCAN_BYTES, settings, small_scans
from lakestar.sources.tables import (
    replace_partition, scd2_merge, table_insert_new, table_overwrite, table_read,
)
from lakestar.sources.writers import export_documents


def run_gold(
    spark: SparkSession, layout: Layout, as_of: datetime, source_system: str,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Load the star schema from silver; returns metrics (step, metric, value).

    The fact takes its keys from silver as well, so all five loads are independent.

    ``measured`` (track_id, popularity) gives the day's popularity, for example the newest staged
    snapshot; the highest counts if a track occurs repeatedly. Without it the fact repeats the
    popularity of the first time a track was seen, since silver tracks are insert-only.
    """
    metrics = Metrics()
    loading = (source_system, as_of)
    # The dimensions sort wide rows as every task reads them.
    with settings(spark, small_scans(spark, 2 * SORTED_SCAN_BYTES) | DROP_SHUFFLES):
        metrics.run({
            "dim_artists": partial(
                load_dimension_scd2, spark, layout, "artists", DIM_ARTISTS, "artist_key", *loading),
            "dim_albums": partial(
                load_dimension_scd2, spark, layout, "albums", DIM_ALBUMS, "album_key", *loading),
            "dim_tracks": partial(
                load_dimension_insert_only, spark, layout, "tracks", DIM_TRACKS, "track_key", *loading),
            "dim_dates": partial(load_dim_dates, spark, layout, as_of),
            "fact_track_plays": partial(load_fact, spark, layout, as_of, source_system, measured),
        })
    return metrics.frame(spark)


def load_dimension_scd2(
    spark: SparkSession, layout: Layout, silver: str, contract: Contract, key_name: str,
    source_system: str, as_of: datetime,
) -> dict[str, int]:
    """Merge the current silver rows into a type 2 dimension."""
    staged = dimension_scd2(
        table_read(spark, f"{layout.silver}/{silver}"), contract.keys[0], key_name, source_system,
        as_of, contract.columns, contract.renames,
    )
    path = f"{layout.gold}/{contract.name}"
    return scd2_merge(staged, path, contract.keys, as_of, columns=contract.columns)


def load_dimension_insert_only(
    spark: SparkSession, layout: Layout, silver: str, contract: Contract, key_name: str,
    source_system: str, as_of: datetime,
) -> dict[str, int]:
    """Append the silver rows whose entity the dimension does not hold yet."""
    staged = dimension_insert_only(
        table_read(spark, f"{layout.silver}/{silver}"), contract.keys[0], key_name, source_system,
        as_of, contract.columns, {new: old for old, new in contract.renames.items()},
    )
    return {"inserted": table_insert_new(staged, f"{layout.gold}/{contract.name}", contract.keys)}


def load_dim_dates(spark: SparkSession, layout: Layout, as_of: datetime) -> dict[str, int]:
    """Write the ten-year calendar around the load day."""
    first, last = calendar_bounds(F.lit(as_of.date()))
    days = date_dimension(date_spine(spark.range(1), first, last))
    return {"version": table_overwrite(days, f"{layout.gold}/dim_dates")}


def load_fact(
    spark: SparkSession, layout: Layout, as_of: datetime, source_system: str,
    measured: DataFrame | None = None,
) -> dict[str, int]:
    """Replace the day's slice of the fact by one row per silver track.

    Rows are joined by their natural keys, a fraction as wide as the durable ones, which are made last.
    """
    tracks = table_read(spark, f"{layout.silver}/tracks")
    if measured is not None:
        latest = measured.groupBy("track_id").agg(F.max("popularity").alias("measured"))
        tracks = tracks.join(latest, "track_id", "left").withColumn(
            "popularity", F.coalesce("measured", "popularity"))
    tracks = tracks.withColumn("track_key", F.col("track_id"))
    lookups = []
    for silver, natural, key in (("artists", "artist_id", "artist_key"), ("albums", "album_id", "album_key")):
        rows = current_rows(table_read(spark, f"{layout.silver}/{silver}"))
        lookups.append(Lookup(rows.withColumn(key, F.col(natural)), natural, key))
    fact = snapshot_fact(
        tracks, lookups, ["popularity"],
        {"date_key": date_key(F.lit(as_of.date())), "play_count": F.lit(1), "last_updated": as_of},
        keep=["track_key"],
    )
    keys = ("track_key", *(lookup.key for lookup in lookups))
    fact = fact.withColumns({key: surrogate_key(key, source=source_system) for key in keys})
    path = f"{layout.gold}/{FACT_TRACK_PLAYS.name}"
    fact, day = fact.select(*FACT_TRACK_PLAYS.columns), int(as_of.strftime("%Y%m%d"))
    return {"written": replace_partition(fact, path, "date_key", [day])}


# Collections of the document export: name, table, timestamp columns to fill.
COLLECTIONS = (
    ("artists", "dim_artists", ("valid_from", "last_updated")),
    ("albums", "dim_albums", ("valid_from", "last_updated")),
    ("tracks", "dim_tracks", ("valid_from", "last_updated")),
    ("track_plays", "fact_track_plays", ("last_updated",)),
)


def run_export(spark: SparkSession, layout: Layout, as_of: datetime) -> dict[str, str]:
    """Replace every document collection by the current content of its table.

    Documents are lines of gzip files. Returns the folder of each collection, and under ``profile`` that of the profile of the tables:
    columns, types, nulls and rows, taken before the export.
    """
    profile = f"{layout.rejected}/export/export_{run_stamp(as_of)}"
    exported = {name: table_read(spark, f"{layout.gold}/{table}") for name, table, _ in COLLECTIONS}
    table_profile(exported).write.mode("overwrite").json(profile)
    return {"profile": profile} | {
        name: export_documents(
            exported[name], f"{layout.documents}/{name}", as_of, fill, compression="gzip")
        for name, _, fill in COLLECTIONS
    }


def analysis(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The ranked queries over the star schema."""
    artists = current_rows(table_read(spark, f"{layout.gold}/dim_artists"))
    albums = current_rows(table_read(spark, f"{layout.gold}/dim_albums"))
    tracks = table_read(spark, f"{layout.gold}/dim_tracks")
    return {
        "artists_by_rows": top_groups_by_count(tracks, "artist_id", "count"),
        "artists_by_popularity": top_entities_by_avg(
            tracks, artists, "artist_id", "popularity", "artist_name", "avg_popularity"),
        "popularity_by_year": avg_by_year(
            tracks, "song_added", "popularity", "year_added", "avg_popularity"),
        "albums_by_popularity": top_groups_prelimit(
            tracks, albums, "album_id", "popularity", "album_name", "total_popularity"),
    }
