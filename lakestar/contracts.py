"""Declared entity contracts: one schema per table, applied to every format at read time."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Contract:
    """Schema of one table with its natural key and the columns whose changes are versioned.

    ``tracked`` defaults to every column that is neither part of the key nor bookkeeping.
    ``renames`` maps source names to canonical ones and ``dates`` names the columns that may hold
    partial dates in the source.
    """

    name: str
    ddl: str
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def tracked(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c not in BOOKKEEPING]

    def text_schema(self) -> StructType:
        """All columns as text under their source names, for formats without types."""
        source = {canonical: original for original, canonical in self.renames.items()}
        return StructType.fromDDL(", ".join(f"`{source.get(c, c)}` string" for c in self.columns))


BOOKKEEPING = {
    "extraction_date", "source_file", "hash_key", "is_current", "valid_from", "valid_to",
    "source_system", "last_updated", "artist_key", "album_key", "track_key",
}

SCD_COLUMNS = ("is_current", "valid_from", "valid_to")

# Column names, types and natural keys of the tables of each layer.
RAW_ARTISTS = Contract(
    "raw_artists",
    "artist_id string, artist_name string, external_url string, extraction_date timestamp",
    keys=("artist_id",),
    required=("artist_id", "artist_name"),
)
RAW_ALBUMS = Contract(
    "raw_albums",
    "album_id string, name string, release_date string, total_tracks string, url string, "
    "artist_id string, extraction_date string",
    keys=("album_id",),
    required=("album_id", "name", "artist_id"),
)
RAW_TRACKS = Contract(
    "raw_tracks",
    "song_id string, song_name string, duration_ms string, url string, popularity string, "
    "song_added string, album_id string, artist_id string, extraction_date string",
    keys=("song_id",),
    required=("song_id",),
)
STAGED_ARTISTS = Contract(
    "staged_artists",
    "artist_id string, artist_name string, external_url string, extraction_date timestamp",
    keys=("artist_id",),
    required=("artist_id", "artist_name"),
)
STAGED_ALBUMS = Contract(
    "staged_albums",
    "album_id string, name string, release_date timestamp, total_tracks int, url string, "
    "artist_id string, extraction_date timestamp",
    keys=("album_id",),
    required=("album_id", "name", "artist_id"),
    dates=("release_date",),
)
STAGED_TRACKS = Contract(
    "staged_tracks",
    "track_id string, name string, duration_ms int, url string, popularity int, "
    "song_added string, album_id string, artist_id string, extraction_date timestamp",
    keys=("track_id",),
    required=("track_id",),
    renames={"song_id": "track_id", "song_name": "name"},
)
SILVER_ARTISTS = Contract(
    "silver_artists",
    "artist_id string, artist_name string, external_url string, extraction_date timestamp, "
    "source_file string, hash_key string, is_current boolean, valid_from timestamp, "
    "valid_to timestamp",
    keys=("artist_id",),
    required=("artist_id", "artist_name"),
)
SILVER_ALBUMS = Contract(
    "silver_albums",
    "album_id string, name string, release_date timestamp, total_tracks int, url string, "
    "artist_id string, extraction_date timestamp, source_file string, hash_key string, "
    "is_current boolean, valid_from timestamp, valid_to timestamp",
    keys=("album_id",),
    required=("album_id", "name", "artist_id"),
)
SILVER_TRACKS = Contract(
    "silver_tracks",
    "track_id string, name string, duration_ms int, url string, popularity int, "
    "song_added string, album_id string, artist_id string, extraction_date timestamp, "
    "source_file string",
    keys=("track_id",),
    required=("track_id",),
)
DIM_ARTISTS = Contract(
    "dim_artists",
    "artist_key string, artist_id string, artist_name string, external_url string, "
    "is_current boolean, valid_from timestamp, valid_to timestamp, hash_key string, "
    "source_system string, last_updated timestamp",
    keys=("artist_id",),
)
DIM_ALBUMS = Contract(
    "dim_albums",
    "album_key string, album_id string, album_name string, release_date timestamp, "
    "total_tracks int, url string, artist_id string, is_current boolean, valid_from timestamp, "
    "valid_to timestamp, hash_key string, source_system string, last_updated timestamp",
    keys=("album_id",),
    renames={"name": "album_name"},
)
DIM_TRACKS = Contract(
    "dim_tracks",
    "track_key string, track_id string, track_name string, duration_ms int, url string, "
    "popularity int, song_added string, album_id string, artist_id string, is_current boolean, "
    "valid_from timestamp, valid_to timestamp, source_system string, last_updated timestamp",
    keys=("track_id",),
    renames={"name": "track_name"},
)
DIM_DATES = Contract(
    "dim_dates",
    "calendar_date date, date_key int, year int, month int, day_of_month int, day_of_week int, "
    "week_of_year int, quarter int",
    keys=("calendar_date",),
)
FACT_TRACK_PLAYS = Contract(
    "fact_track_plays",
    "track_key string, artist_key string, album_key string, popularity int, date_key int, "
    "play_count int, last_updated timestamp",
    keys=("track_key", "date_key"),
)

TABLES = {
    c.name: c
    for c in (
        RAW_ARTISTS, RAW_ALBUMS, RAW_TRACKS, SILVER_ARTISTS, SILVER_ALBUMS, SILVER_TRACKS,
        DIM_ARTISTS, DIM_ALBUMS, DIM_TRACKS, DIM_DATES, FACT_TRACK_PLAYS,
    )
}


def declare_table(spark: SparkSession, contract: Contract, path: str, name: str | None = None) -> str:
    """Declare an external Parquet table over a folder unless the name is already taken."""
    name = name or contract.name
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=contract.schema)
    return name
