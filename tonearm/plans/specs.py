"""Which dimensions and facts are loaded, and how."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: overwritten in place (type 1) or versioned (type 2)."""

    name: str
    scd_type: int
    key: str
    columns: tuple[str, ...]
    compared: tuple[str, ...]
    staging_format: str = "parquet"
    # staged as large as the dimension itself, so merged with the strategy "full", which reads each side once; a rebuild
    # from the whole history is that too
    whole: bool = False

    @property
    def strategy(self) -> str:
        return "full" if self.whole else "delta"


@dataclass(frozen=True)
class FactSpec:
    """A fact table: rows whose keys are absent are added."""

    name: str
    partition_key: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]


def _dimension(name: str, scd_type: int, key: str, compared: str, **options) -> DimensionSpec:
    names = tuple(compared.split())
    return DimensionSpec(name, scd_type, key, (key, *names), names, **options)


# --- fixed values: tables, keys and compared columns ---------------------------------------
DIMENSIONS = {
    spec.name: spec
    for spec in (
        _dimension(
            "dim_album", 1, "album_key",
            "name url cover_image album_type release_date_key release_date_precision label",
        ),
        _dimension(
            "dim_artist", 2, "artist_key", "name genres url followers_count monthly_listeners",
            staging_format="orc",
        ),
        _dimension("dim_genre", 1, "genre_key", "name", whole=True),
        _dimension(
            "dim_playlist", 2, "playlist_key",
            "name url collaborative is_public snapshot_id followers_count user_key",
        ),
        _dimension(
            "dim_track", 2, "track_key",
            "name url album_key disc_number duration_ms is_explicit plays_count",
        ),
        _dimension("dim_user", 1, "user_key", "name url"),
    )
}

_ALBUM_TRACK = ("release_date_key", "album_key", "artist_key", "genre_key", "track_key")
_PLAYLIST_TRACK = ("added_date_key", "playlist_key", "user_key", "genre_key", "track_key")

FACTS = {
    spec.name: spec
    for spec in (
        FactSpec("fact_album_track", "release_date_key", _ALBUM_TRACK, _ALBUM_TRACK),
        FactSpec(
            "fact_playlist_track", "added_date_key", _PLAYLIST_TRACK, (*_PLAYLIST_TRACK, "date_actual")
        ),
    )
}
# ------------------------------------------------------------------------------------------
