"""Source schemas, code tables and unknown members."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import IntegerType, StructType

# --- fixed values -------------------------------------------------------------------------
UNKNOWN_INT = -1
UNKNOWN_STR = "unknown"
UNKNOWN_DATE_KEY = 0

ALBUM_TYPE_CODES = {"album": 1, "single": 2, "compilation": 3}
DATE_PRECISION_CODES = {"year": 1, "month": 2, "day": 3}

SOURCE_DDL = {
    "album": (
        "album_id string, created_at timestamp, updated_at timestamp, "
        "available_markets array<string>, url string, cover_image string, name string, "
        "release_date string, release_date_precision string, restrictions array<string>, "
        "label string, popularity smallint, album_type string"
    ),
    "artist": (
        "artist_id string, created_at timestamp, updated_at timestamp, url string, "
        "followers_count int, genres array<string>, image string, name string, "
        "popularity smallint, monthly_listeners bigint"
    ),
    "artist_album": "artist_id string, album_id string, created_at timestamp, updated_at timestamp",
    "artist_track": "artist_id string, track_id string, created_at timestamp, updated_at timestamp",
    "playlist": (
        "playlist_id string, created_at timestamp, updated_at timestamp, collaborative boolean, "
        "description string, url string, followers_count int, cover_image string, name string, "
        "user_id string, public boolean, snapshot_id string"
    ),
    "playlist_track": (
        "playlist_id string, track_id string, added_at string, added_by string, url string, "
        "created_at timestamp, updated_at timestamp"
    ),
    "track": (
        "track_id string, created_at timestamp, updated_at timestamp, album_id string, "
        "available_markets array<string>, disc_number int, duration_ms int, explicit boolean, "
        "url string, name string, popularity smallint, restrictions array<string>, "
        "track_number int, plays_count bigint"
    ),
    "user": (
        "user_id string, created_at timestamp, updated_at timestamp, url string, image string, "
        "name string"
    ),
}

TRACKING_DDL = "function_name string, main_arg_name string, main_arg_value string, tracked_at date"

EXTRACT_COLUMNS = ["extract_year", "extract_month", "extract_day"]
# ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceTable:
    """One source table and how it is extracted."""

    name: str
    keys: tuple[str, ...]
    incremental_col: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(SOURCE_DDL[self.name])

    @property
    def lake_schema(self) -> StructType:
        schema = self.schema
        for column in EXTRACT_COLUMNS:
            schema = schema.add(column, IntegerType())
        return schema


SOURCE_TABLES = {
    table.name: table
    for table in (
        SourceTable("album", ("album_id",), "updated_at"),
        SourceTable("artist", ("artist_id",), "updated_at"),
        SourceTable("artist_album", ("artist_id", "album_id"), "created_at"),
        SourceTable("artist_track", ("artist_id", "track_id"), "updated_at"),
        SourceTable("playlist", ("playlist_id",), "updated_at"),
        SourceTable("playlist_track", ("playlist_id", "track_id"), "created_at"),
        SourceTable("track", ("track_id",), "updated_at"),
        SourceTable("user", ("user_id",), "updated_at"),
    )
}
