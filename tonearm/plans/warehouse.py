"""The daily warehouse run: stage, load, marts.

Each step writes a table and the next reads it, so lineage stays short, later plans see true
table sizes, and a failed run is repeated from the start with the same outcome.

Tables may come in any order. Bridges, tracks and playlist entries are indexed by the ids they are looked up by, so a
run finds what its artists, albums and links of the day touch without reading the history.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.dates import audit_stamps
from tonearm.operators.fold import MASK, WORD
from tonearm.operators.lookup import not_in
from tonearm.operators.merge import insert_absent, key_range, scd1, scd2_open_rows
from tonearm.plans import dims, facts, marts
from tonearm.plans.specs import DIMENSIONS, FACTS, DimensionSpec, FactSpec
from tonearm.schemas import SOURCE_TABLES
from tonearm.session import side_by_side
from tonearm.sources import warehouse
from tonearm.sources.lake import extracted_between, missing_or_empty, read_lake

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Places:
    """Roots of the lake, the staging tables and the warehouse."""

    lake: str
    staging: str
    warehouse: str

    def staging_of(self, run: int) -> str:
        return f"{self.staging.rstrip('/')}/run_{run}"


def read_dimension(
    spark: SparkSession, root: str, name: str, before: int | None = None, open_only: bool = True
) -> DataFrame | None:
    spec = DIMENSIONS[name]
    if spec.scd_type == 1:
        return warehouse.read_snapshot(spark, root, name, before)
    return warehouse.read_versions(spark, root, name, before, open_only)


# ---- staging -------------------------------------------------------------------------------


def _stage(df: DataFrame, places: Places, run: int, name: str, fmt: str = "parquet") -> None:
    warehouse.write_staging(df, places.staging_of(run), name, fmt)
    logger.info("staged %s", name)


def stage_dimensions(
    spark: SparkSession, places: Places, run_date: dt.date, rebuild: bool = False
) -> list[str]:
    """Stage the dimensions whose source has an extract of the day; the rest are skipped.

    The artists of the day are merged into those held; ``rebuild`` stages them from the whole history instead.
    """
    run = warehouse.run_number(run_date)

    def extract(table: str, whole: bool = False) -> DataFrame | None:
        return read_lake(spark, places.lake, SOURCE_TABLES[table], None if whole else run_date)

    known_genres = read_dimension(spark, places.warehouse, "dim_genre", before=run)
    jobs = {
        "dim_album": (extract("album"), dims.stage_album),
        "dim_artist": (extract("artist", whole=rebuild), dims.stage_artist),
        "dim_genre": (
            extract("artist"),
            lambda df: dims.with_unknown_genre(dims.stage_genre(df, known_genres)),
        ),
        "dim_playlist": (extract("playlist"), dims.stage_playlist),
        "dim_user": (extract("user"), dims.stage_user),
        "dim_track": (extract("track"), dims.stage_track),
    }

    def stage(name: str) -> str | None:
        source, job = jobs[name]
        if missing_or_empty(source):
            logger.info("no source rows for %s", name)
            return None
        spec = DIMENSIONS[name]
        _stage(job(source).select(*spec.columns), places, run, name, spec.staging_format)
        return name

    staged = side_by_side([lambda name=name: stage(name) for name in jobs])
    return [name for name in staged if name is not None]


PENDING = "pending_tracks"
PENDING_ENTRIES = "pending_entries"
TRACK_COLUMNS = ["track_id", "album_id", "created_at"]
ENTRY_COLUMNS = ["playlist_id", "track_id", "added_at"]

#: Source table → the indexes kept of it, and their columns.
INDEXES = {
    "track": (["tracks_by_album"], TRACK_COLUMNS),
    "artist_album": (["albums_by_artist", "artists_by_album"], ["artist_id", "album_id"]),
    "artist_track": (["tracks_by_artist", "artists_by_track"], ["artist_id", "track_id"]),
    "playlist_track": (["entries_by_track", "entries_by_playlist"], ENTRY_COLUMNS),
}


def index_sources(spark: SparkSession, places: Places, run_date: dt.date) -> list[str]:
    """Add to each index what the lake gained since the last run that did so: a day's rows, the history at first."""
    run = warehouse.run_number(run_date)

    def add(source: str, index: str, columns: list[str]) -> str | None:
        rows = read_lake(spark, places.lake, SOURCE_TABLES[source])
        if rows is None:
            return None
        done = warehouse.latest_unit(spark, places.warehouse, index, before=run)
        since = None if done is None else dt.datetime.strptime(str(done.last), "%Y%m%d").date()
        rows = rows.where(extracted_between(since, run_date)).select(*columns).dropDuplicates()
        warehouse.write_facts(rows, places.warehouse, index, run)
        return index

    jobs = [
        lambda source=source, index=index, columns=columns: add(source, index, columns)
        for source, (indexes, columns) in INDEXES.items()
        for index in indexes
    ]
    return [name for name in side_by_side(jobs) if name is not None]


def changed_artists(spark: SparkSession, places: Places, run_date: dt.date) -> DataFrame | None:
    """artist_id of the artists of the day that are new or have other genres than before it."""
    artists = read_lake(spark, places.lake, SOURCE_TABLES["artist"], run_date)
    if artists is None:
        return None
    held = read_dimension(spark, places.warehouse, "dim_artist", before=warehouse.run_number(run_date))
    if held is None:
        return artists.select("artist_id").dropDuplicates()
    held = held.select(F.col("artist_key").alias("artist_id"), F.col("genres").alias("held_genres"), F.lit(True).alias("is_held"))
    both = artists.select("artist_id", "genres").join(held, "artist_id", "left")
    changed = both.where(F.col("is_held").isNull() | ~F.col("genres").eqNullSafe(F.col("held_genres")))
    return changed.select("artist_id").dropDuplicates()


def _stored(df: DataFrame, places: Places, run: int, name: str) -> DataFrame:
    """A working table of the run."""
    warehouse.write_staging(df, places.staging_of(run), name)
    return df.sparkSession.read.schema(df.schema).parquet(f"{places.staging_of(run)}/{name}")


def _union(*parts: DataFrame | None) -> DataFrame | None:
    """The distinct rows of the tables that are there."""
    present = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, present).dropDuplicates() if present else None


def touched(
    spark: SparkSession, places: Places, run_date: dt.date, links: str, key: str, by_artist: str, changed: DataFrame | None
) -> DataFrame | None:
    """``key`` of what gained an artist in the extract of the day, or whose artist is new or has other genres."""
    run = warehouse.run_number(run_date)
    of_day = read_lake(spark, places.lake, SOURCE_TABLES[links], run_date)
    of_artists = None if changed is None else warehouse.read_index(spark, places.warehouse, by_artist, changed, run + 1)
    return _union(*(None if rows is None else rows.select(key) for rows in (of_day, of_artists)))


def candidate_tracks(
    spark: SparkSession, places: Places, run_date: dt.date, changed: DataFrame | None
) -> DataFrame | None:
    """Tracks that may give new facts: of the day, left pending by earlier runs, on touched albums.

    Neither facts nor the history of tracks are read for this, so the cost follows the day.
    """
    run = warehouse.run_number(run_date)
    of_day = read_lake(spark, places.lake, SOURCE_TABLES["track"], run_date)
    albums_of_day = read_lake(spark, places.lake, SOURCE_TABLES["album"], run_date)
    albums = _union(
        touched(spark, places, run_date, "artist_album", "album_id", "albums_by_artist", changed),
        None if albums_of_day is None else albums_of_day.select("album_id"),
    )
    again = None
    if albums is not None:
        albums = _stored(albums, places, run, "touched_albums")
        again = warehouse.read_index(spark, places.warehouse, "tracks_by_album", albums, run + 1)
    return _union(
        None if of_day is None else of_day.select(*TRACK_COLUMNS),
        again,
        warehouse.read_snapshot(spark, places.warehouse, PENDING, before=run),
    )


def new_playlists(spark: SparkSession, places: Places, run_date: dt.date) -> DataFrame | None:
    """playlist_id of the playlists that the day brought."""
    of_day = read_lake(spark, places.lake, SOURCE_TABLES["playlist"], run_date)
    if of_day is None:
        return None
    ids = of_day.select("playlist_id").dropDuplicates()
    held = read_dimension(spark, places.warehouse, "dim_playlist", before=warehouse.run_number(run_date))
    return ids if held is None else not_in(ids, held.select(F.col("playlist_key").alias("playlist_id")), ["playlist_id"])


def candidate_entries(
    spark: SparkSession, places: Places, run_date: dt.date, changed: DataFrame | None
) -> DataFrame | None:
    """Playlist entries that may give new facts: of the day, left pending, of touched tracks and of new playlists."""
    run = warehouse.run_number(run_date)
    of_day = read_lake(spark, places.lake, SOURCE_TABLES["playlist_track"], run_date)
    tracks = touched(spark, places, run_date, "artist_track", "track_id", "tracks_by_artist", changed)
    playlists = new_playlists(spark, places, run_date)
    again = []
    for index, name, keys in (("entries_by_track", "touched_tracks", tracks), ("entries_by_playlist", "new_playlists", playlists)):
        if keys is not None:
            keys = _stored(keys, places, run, name)
            again.append(warehouse.read_index(spark, places.warehouse, index, keys, run + 1))
    return _union(
        None if of_day is None else of_day.select(*ENTRY_COLUMNS),
        *again,
        warehouse.read_snapshot(spark, places.warehouse, PENDING_ENTRIES, before=run),
    )


def stage_facts(spark: SparkSession, places: Places, run_date: dt.date) -> list[str]:
    """Stage the facts of the day; tracks and entries that earlier runs could not place are tried again.

    While a table they need is missing, they all stay pending.
    """
    run = warehouse.run_number(run_date)
    index_sources(spark, places, run_date)
    dimension = {
        name: read_dimension(spark, places.warehouse, name, before=run + 1)
        for name in ("dim_album", "dim_artist", "dim_genre", "dim_playlist")
    }
    changed = changed_artists(spark, places, run_date)
    changed = None if changed is None else _stored(changed, places, run, "changed_artists")

    def place(find, name: str, index: str, key: str, needed: list, build, pending: str) -> str | None:
        """Stage the facts of candidates, folded by genre; candidates without any are kept as pending."""
        candidates = find(spark, places, run_date, changed)
        if missing_or_empty(candidates):
            return None
        candidates = _stored(candidates, places, run, f"{pending}_tried")
        bridge = warehouse.read_index(spark, places.warehouse, index, candidates.select(key).dropDuplicates(), run + 1)
        needed = [bridge, *needed]
        left, complete = candidates, all(df is not None for df in needed)
        if complete:
            _stage(build(candidates, *needed, folded=True), places, run, name)
            placed = warehouse.read_table(spark, places.staging_of(run), name)
            left = facts.unplaced_tracks(candidates, placed)
        warehouse.write_snapshot(left, places.warehouse, pending, run)
        return name if complete else None

    known = [dimension["dim_artist"], dimension["dim_genre"]]
    staged = side_by_side([
        lambda: place(
            candidate_tracks, "fact_album_track", "artists_by_album", "album_id",
            [dimension["dim_album"], *known], facts.album_track, PENDING,
        ),
        lambda: place(
            candidate_entries, "fact_playlist_track", "artists_by_track", "track_id",
            [dimension["dim_playlist"], *known], facts.playlist_track, PENDING_ENTRIES,
        ),
    ])
    return [name for name in staged if name is not None]


# ---- loading -------------------------------------------------------------------------------


def load_dimension(
    spark: SparkSession, spec: DimensionSpec, places: Places, run_date: dt.date, rebuild: bool = False
) -> bool:
    """Merge the staged rows of a dimension; False when nothing was staged."""
    run = warehouse.run_number(run_date)
    staged = warehouse.read_table(spark, places.staging_of(run), spec.name, spec.staging_format)
    if staged is None:
        return False
    as_of = dt.datetime.combine(run_date, dt.time())
    strategy = "full" if rebuild else spec.strategy
    held = read_dimension(spark, places.warehouse, spec.name, before=run)
    if spec.scd_type == 1:
        if held is None:
            merged = staged.withColumns(audit_stamps(as_of))
        else:
            merged = scd1(held, staged, [spec.key], as_of, spec.compared, strategy)
        warehouse.write_snapshot(merged, places.warehouse, spec.name, run)
    else:
        if held is None:
            merged = staged.withColumns(
                {
                    "valid_from": F.lit(run_date),
                    "valid_to": F.lit(None).cast("date"),
                    "flag": F.lit(True),
                }
            )
        else:
            merged = scd2_open_rows(held, staged, [spec.key], run_date, spec.compared, strategy)
        warehouse.write_versions(merged, places.warehouse, spec.name, run)
    return True


def load_dimensions(
    spark: SparkSession, places: Places, run_date: dt.date, rebuild: bool = False
) -> list[str]:
    specs = list(DIMENSIONS.values())
    loaded = side_by_side(
        [lambda spec=spec: load_dimension(spark, spec, places, run_date, rebuild) for spec in specs]
    )
    return [spec.name for spec, done in zip(specs, loaded) if done]


def load_fact(spark: SparkSession, spec: FactSpec, places: Places, run_date: dt.date) -> bool:
    """Add the staged facts, folded or not, that the table lacks; False when nothing was staged."""
    run = warehouse.run_number(run_date)
    staged = warehouse.read_table(spark, places.staging_of(run), spec.name)
    if staged is None:
        return False
    layout = warehouse.FACT_LAYOUT[spec.name]
    masks = MASK in staged.columns
    staged = staged.select(*[c for c in spec.columns if not (masks and c == layout.folded)], *([WORD, MASK] if masks else []))
    held = warehouse.read_facts(spark, places.warehouse, spec.name, before=run)
    if held is not None:
        staged = insert_absent(held, staged, spec.keys, spec.partition_key, layout.reachable, layout.folded)
    warehouse.write_facts(staged, places.warehouse, spec.name, run)
    return True


def load_metric(spark: SparkSession, places: Places, run_date: dt.date) -> bool:
    """Count the new album tracks of the run, from the facts as they were before it."""
    run = warehouse.run_number(run_date)
    staged = warehouse.read_table(spark, places.staging_of(run), "fact_album_track")
    if staged is None:
        return False
    held = warehouse.read_facts(spark, places.warehouse, "fact_album_track", before=run)
    if held is not None:
        spec = FACTS["fact_album_track"]
        low, high = key_range(staged, spec.partition_key)
        if low is not None:
            held = held.where(warehouse.FACT_LAYOUT[spec.name].reachable(low, high))
    metric = marts.album_track_metric(staged, held, date_dimension(spark, places))
    warehouse.write_snapshot(metric, places.warehouse, "album_track_metric", run)
    return True


def read_metric(spark: SparkSession, root: str) -> DataFrame | None:
    """The metric over all committed runs."""
    rows = warehouse.read_facts(spark, root, "album_track_metric")
    return None if rows is None else marts.total_album_track_metric(rows)


def load_facts(spark: SparkSession, places: Places, run_date: dt.date) -> list[str]:
    """The metric and the facts; all of them read the facts of earlier runs, so none waits for another."""
    jobs = {"album_track_metric": lambda: load_metric(spark, places, run_date)}
    jobs |= {s.name: lambda s=s: load_fact(spark, s, places, run_date) for s in FACTS.values()}
    return [name for name, done in zip(jobs, side_by_side(list(jobs.values()))) if done]


def date_dimension(spark: SparkSession, places: Places) -> DataFrame:
    """The stored date dimension, generated once."""
    held = warehouse.read_snapshot(spark, places.warehouse, "dim_date")
    if held is None:
        warehouse.write_snapshot(dims.date_dimension(spark).coalesce(1), places.warehouse, "dim_date", 0)
        held = warehouse.read_snapshot(spark, places.warehouse, "dim_date")
    return held


def refresh_marts(spark: SparkSession, places: Places, run_date: dt.date) -> list[str]:
    """Recompute the two preference marts from all playlist facts."""
    run = warehouse.run_number(run_date)
    rows = warehouse.read_facts(spark, places.warehouse, "fact_playlist_track")
    users, genres, tracks = (
        read_dimension(spark, places.warehouse, name) for name in ("dim_user", "dim_genre", "dim_track")
    )
    if rows is None or tracks is None:
        return []
    made = {}
    if users is not None and genres is not None:
        made["user_genre_preference"] = marts.user_genre_preference(rows, users, genres, tracks)
    made["favorite_track"] = marts.favorite_track(rows, date_dimension(spark, places), tracks)
    side_by_side([lambda name=name: warehouse.write_snapshot(made[name], places.warehouse, name, run) for name in made])
    return list(made)


def compact_month(spark: SparkSession, places: Places, month: dt.date, keep_runs: int = 2) -> dict[str, int]:
    """Gather the runs of a month, of the fact tables and the indexes, and drop what no reader needs any more.

    The number of the compacted folder of each table that had several; the last run is left as it is.
    """
    first = warehouse.run_number(month.replace(day=1))
    done = {}
    for table in (*FACTS, *(index for indexes, _ in INDEXES.values() for index in indexes)):
        number = warehouse.compact(spark, places.warehouse, table, first, first + 30)
        if number is not None:
            done[table] = number
        warehouse.remove_replaced(spark, places.warehouse, table, keep_runs)
    for table in (PENDING, PENDING_ENTRIES, "user_genre_preference", "favorite_track"):
        warehouse.remove_snapshots(spark, places.warehouse, table, keep_runs)
    return done


def run_day(
    spark: SparkSession, places: Places, run_date: dt.date, rebuild: bool = False
) -> dict[str, list[str]]:
    """Everything of one day, in order; which tables each stage wrote."""
    return {
        "staged dimensions": stage_dimensions(spark, places, run_date, rebuild),
        "loaded dimensions": load_dimensions(spark, places, run_date, rebuild),
        "staged facts": stage_facts(spark, places, run_date),
        "loaded facts": load_facts(spark, places, run_date),
        "marts": refresh_marts(spark, places, run_date),
    }
