"""Inputs that the registered queries derive from the supplied tables.

The supplied tables hold no nulls, changes or nested records, so these are derived by rules on their
columns. All rows of a table are read; the oracle SQL applies the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.sources.pages import ALBUM, ARTIST, TRACK

LINK = "web"
ARTISTS = f"array<{ARTIST}>"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores before costly expressions, if the scan has fewer partitions.

    A supplied file is a single row group, hence a single task. A scan of a large table has more
    partitions than the cluster has cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cents(column: str) -> Column:
    """Money as whole cents: sums of integers do not depend on the order of the rows."""
    return F.round(F.col(column) * 100).cast("bigint")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _urls(kind: str, key: Column) -> Column:
    return F.create_map(F.lit(LINK), F.concat(F.lit(f"http://{kind}/"), key))


def _artist(key: Column, order: Column, suffix: Column) -> Column:
    name = F.concat(F.lit('artist "'), key, F.lit('" of '), order, suffix)
    return F.struct(key.alias("id"), name.alias("name"), _urls("artist", key).alias("external_urls"))


def pages(spark: SparkSession, sf: str, renamed: bool = False) -> DataFrame:
    """One nested page per lineitem row: a track, an item without a track, and a bare track.

    The order stands for playlist and album, the part for the track, the supplier for the artist.
    Line 7 has no artists, returned lines have no album and the bare track has neither. With
    ``renamed`` every seventh supplier has another name, as in a later extract. The parts are built in the
    types of a page: a cast of nested records copies all that they hold, once per level.
    """
    line = spread(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
    ))
    order, part, supplier = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey"))
    following = (F.col("l_suppkey") + 1).cast("string")

    def suffix(key: Column) -> Column:
        return F.when(F.lit(renamed) & (key % 7 == 0), " (renamed)").otherwise("")

    artists = F.when(F.col("l_linenumber") == 7, F.array().cast(ARTISTS)).otherwise(F.array(
        _artist(supplier, order, suffix(F.col("l_suppkey"))),
        _artist(following, order, suffix(F.col("l_suppkey") + 1)),
    ))
    owner = (F.col("l_orderkey") % 97).cast("string")
    album = F.when(F.col("l_returnflag") != "R", F.struct(
        order.alias("id"),
        F.concat(F.lit("album\n"), order).alias("name"),
        F.concat((F.lit(1950) + F.col("l_orderkey") % 70).cast("string"), F.lit("-05")).alias("release_date"),
        (F.col("l_orderkey") % 20 + 1).cast("int").alias("total_tracks"),
        _urls("album", order).alias("external_urls"),
        F.array(_artist(owner, order, F.lit(""))).alias("artists"),
    ))
    added = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    track = F.struct(
        part.alias("id"),
        F.concat(F.lit("track "), part).alias("name"),
        (F.col("l_partkey") * 10).cast("int").alias("duration_ms"),
        (F.col("l_partkey") % 101).cast("int").alias("popularity"),
        _urls("track", part).alias("external_urls"),
        album.alias("album"),
        artists.alias("artists"),
    )
    bare = F.struct(
        F.concat(F.lit("bare "), part).alias("id"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("int").alias("duration_ms"),
        F.lit(None).cast("int").alias("popularity"),
        F.lit(None).cast("map<string,string>").alias("external_urls"),
        F.lit(None).cast(ALBUM).alias("album"),
        F.array().cast(ARTISTS).alias("artists"),
    )
    items = F.array(
        F.struct(added.alias("added_at"), track.alias("track")),
        F.struct(added.alias("added_at"), F.lit(None).cast(TRACK).alias("track")),
        F.struct(F.lit("").alias("added_at"), bare.alias("track")),
    )
    return line.select(
        order.alias("playlist_id"),
        F.col("l_orderkey").alias("playlist_position"),
        F.col("l_linenumber").cast("bigint").alias("page_offset"),
        items.alias("items"),
    )
