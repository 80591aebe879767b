"""Nested playlist pages as a source, flattened into artists, albums and songs.

A page is one stored API response: a playlist, its place in the run, the offset of the page in the
playlist and the items. An item's position is (playlist_position, page_offset, item_position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.dedup import dedup_last_batch
from lakestar.operators.projection import as_column

# Field names of the nested records.
ARTIST = "struct<id: string, name: string, external_urls: map<string, string>>"
ALBUM = (
    "struct<id: string, name: string, release_date: string, total_tracks: int, "
    f"external_urls: map<string, string>, artists: array<{ARTIST}>>"
)
TRACK = (
    "struct<id: string, name: string, duration_ms: int, popularity: int, "
    f"external_urls: map<string, string>, album: {ALBUM}, artists: array<{ARTIST}>>"
)
CORRUPT = "corrupt_record"
ITEMS = f"array<struct<added_at: string, track: {TRACK}>>"
PAGES = f"playlist_id string, playlist_position bigint, page_offset bigint, items {ITEMS}"
POSITION = ("page_offset", "item_position")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages, one JSON document per line, in the declared nested schema.

    The whole text of a page of which any part does not parse is in ``corrupt_record``. A reader of only some
    fields checks only those, so whoever sorts pages out has to read all of them, see `run_extract`.
    """
    reader = spark.read.schema(f"{PAGES}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """(playlist_id, corrupt_record, source_file) of the stored pages of which any part did not parse."""
    # The reader checks the fields it is asked for, so the filter looks at all of them.
    others = F.length(F.to_json(F.struct(*(c for c in pages.columns if c not in (CORRUPT, "source_file")))))
    bad = pages.filter(F.col(CORRUPT).isNotNull() & (others >= 0))
    return bad.select("playlist_id", CORRUPT, "source_file")


def flatten_items(pages: DataFrame) -> DataFrame:
    """One row per item that has a track, with its position.

    The outer form keeps Catalyst from testing the array's size beforehand, which would compute a
    derived array twice; pages without items fall to the filter on the track.
    """
    items = pages.select(
        "playlist_id", "playlist_position", "page_offset",
        F.posexplode_outer("items").alias("item_position", "item"),
    )
    return items.select(
        "playlist_id", "playlist_position", "page_offset", "item_position",
        F.col("item.added_at").alias("added_at"), F.col("item.track").alias("track"),
    ).filter(F.col("track").isNotNull())


def _first_artist(artists: str) -> Column:
    return F.get(F.col(artists), F.lit(0))["id"]


def _url(urls: str, link: str) -> Column:
    return F.try_element_at(F.col(urls), F.lit(link))


def track_artists(items: DataFrame) -> DataFrame:
    """(track_id, artist_id) for every artist of every item, repeats included: the pairs of a bridge."""
    pairs = items.select(F.col("track.id").alias("track_id"), F.explode("track.artists").alias("artist"))
    return pairs.select("track_id", F.col("artist.id").alias("artist_id"))


def flatten_artists(items: DataFrame, extracted: object, link: str) -> DataFrame:
    """One row per artist: as first seen in the last playlist that mentions the artist.

    ``link`` is the entry of the URL map to keep.
    """
    artists = items.select(
        "playlist_position", *POSITION,
        F.posexplode("track.artists").alias("artist_position", "artist"),
    ).select(
        "playlist_position", *POSITION, "artist_position",
        F.col("artist.id").alias("artist_id"),
        F.col("artist.name").alias("artist_name"),
        _url("artist.external_urls", link).alias("external_url"),
    )
    seen = dedup_last_batch(
        artists, ["artist_id"], ["playlist_position"], [*POSITION, "artist_position"]
    )
    return seen.select(
        "artist_id", "artist_name", "external_url", as_column(extracted).alias("extraction_date")
    )


def flatten_albums(items: DataFrame, extracted: object, link: str) -> DataFrame:
    """One row per track with an album, repeats kept; the album's first artist owns it."""
    albums = items.filter(F.col("track.album").isNotNull())
    return albums.select(
        F.col("track.album.id").alias("album_id"),
        F.col("track.album.name").alias("name"),
        F.col("track.album.release_date").alias("release_date"),
        F.col("track.album.total_tracks").alias("total_tracks"),
        _url("track.album.external_urls", link).alias("url"),
        _first_artist("track.album.artists").alias("artist_id"),
        as_column(extracted).alias("extraction_date"),
    )


def entity_counts(items: DataFrame) -> DataFrame:
    """(entity, entity_count): rows that the three flattenings have, from one pass over the items."""
    ids = F.transform("track.artists", lambda artist: artist["id"])
    rows = items.select(
        F.col("track.album").isNotNull().alias("album"), F.posexplode_outer(ids).alias("position", "artist_id"))
    song = F.coalesce("position", F.lit(0)) == 0
    keyless = F.max((F.col("position").isNotNull() & F.col("artist_id").isNull()).cast("bigint"))
    totals = rows.agg(
        (F.count_distinct("artist_id") + F.coalesce(keyless, F.lit(0))).alias("artists"),
        F.count_if(song & F.col("album")).alias("albums"), F.count_if(song).alias("songs"))
    cells = [F.struct(F.lit(c).alias("entity"), F.col(c).alias("entity_count")) for c in totals.columns]
    return totals.select(F.inline(F.array(*cells)))


def flatten_songs(items: DataFrame, extracted: object, link: str) -> DataFrame:
    """One row per track, repeats kept, with the time it was added to the playlist."""
    return items.select(
        F.col("track.id").alias("song_id"),
        F.col("track.name").alias("song_name"),
        F.col("track.duration_ms").alias("duration_ms"),
        _url("track.external_urls", link).alias("url"),
        F.col("track.popularity").alias("popularity"),
        F.col("added_at").alias("song_added"),
        F.col("track.album.id").alias("album_id"),
        _first_artist("track.artists").alias("artist_id"),
        as_column(extracted).alias("extraction_date"),
    )
