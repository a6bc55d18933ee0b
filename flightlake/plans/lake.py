"""The hourly job on versioned tables: each run costs what its new rows cost, and shows up as one commit.

Silver and gold are two bases of ``sources.versions``. A silver run appends the rows whose key is not stored, looking
only into files that can hold one. A gold run takes the silver parts appended since its last commit, carries the phase of each
aircraft on from a state table, merges statistics from partial states, and commits all tables together, so they always
agree on the silver rows they saw. A run that is tried again, or dies anywhere, changes nothing that readers see.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from flightlake.operators import stats
from flightlake.operators.dedupe import append_unique, keep_first
from flightlake.operators.geofence import airport_distance
from flightlake.operators.phase import PhaseUpdate, edges_of, latest_of, merge_edges, update_phases
from flightlake.operators.silver import RESCUED, SILVER_KEYS, rescued_cells, rescuing_rows
from flightlake.plans.gold import run_name, run_stamp
from flightlake.session import materialize, materialize_counted, scratch_scope
from flightlake.sources import versions
from flightlake.sources.inline import airports_frame
from flightlake.sources.key_filters import build_filters, candidate_files
from flightlake.sources.silver_table import flight_date
from flightlake.sources.versions import DAY, Part, Version
from flightlake.streaming.incremental import landed_stream

SILVER, FILTERS, RESCUES = "cleaned_flights", "key_filters", "rescued_cells"
PHASES, EDGES, STATE, PARTIALS = "flight_analytics", "phase_edges", "phase_state", "country_partials"
COUNTRIES, SUMMARY, DISTANCES = "country_stats", "daily_summary", "airport_distance"
TIME = "time_position"
# Below the silver base: the checkpoint that remembers which landing files were read.
LANDED = "_landed"
# A day's parts below this size are put together by a compaction.
SMALL_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Lake:
    """The two bases of a lake."""

    silver: str
    gold: str

    @staticmethod
    def at(folder: str) -> Lake:
        return Lake(f"{folder.rstrip('/')}/silver", f"{folder.rstrip('/')}/gold")


def _next(spark: SparkSession, base: str, ts: datetime | None) -> tuple[Version, Version, str]:
    """The current version, a copy to build the next one in, and the name of the next run's folders."""
    now = versions.current(spark, base)
    coming = Version(now.seq + 1, {t: list(p) for t, p in now.parts.items()}, dict(now.schemas), dict(now.facts))
    return now, coming, f"{run_name(ts)}-{coming.seq:06d}"


def _add(coming: Version, base: str, run: str, table: str, df: DataFrame, by_day: bool = True, appended: bool = True,
         replacing: Sequence[Part] = ()) -> list[Part]:
    """Write a run's rows of ``table`` and put their parts into the coming version, in place of ``replacing``."""
    new = versions.write_parts(df, base, table, run, coming.seq, by_day, appended)
    gone = set(replacing)
    coming.parts[table] = [p for p in coming.parts.get(table, []) if p not in gone] + new
    names = [c for c in df.columns if c != DAY] + ([DAY] if by_day else [])
    coming.schemas[table] = df.select(*names).schema.json()
    return new


def _schema(version: Version, table: str) -> StructType:
    return StructType.fromJson(json.loads(version.schemas[table]))


# --- silver -------------------------------------------------------------------------------------------------------

def files_with_keys(spark: SparkSession, base: str, version: Version, new: DataFrame) -> list[str]:
    """Stored silver files (below the table's folder) that may hold a key of ``new`` (rows with their day)."""
    parts = versions.of_days(version.parts.get(FILTERS, []), versions.days_of(new))
    if not parts:
        return []
    filters = versions.read_parts(spark, base, FILTERS, parts, _schema(version, FILTERS))
    return sorted(r["file"] for r in candidate_files(new, filters, SILVER_KEYS, TIME).collect())


def append_silver_run(spark: SparkSession, lake: Lake, rows: DataFrame, ts: datetime | None = None) -> Version:
    """Commit the ``rows`` whose key is not stored, one per key (the smallest by the other columns).

    Of what is stored, the key columns of those files are read whose time range and filter let a new key
    in; all other files are not opened, whatever the days of the new rows. No new keys: no commit. Rows of
    ``rescuing_rows`` have their unconverted cells written to a side table of the same commit; silver is the same without them.
    """
    now, coming, run = _next(spark, lake.silver, ts)
    with scratch_scope(spark):
        staged, n = materialize_counted(rows.withColumn(DAY, flight_date(TIME)), "lake-new")
        if not n:
            return now
        new = staged.drop(RESCUED, "source_file")
        files = files_with_keys(spark, lake.silver, now, new)
        if files:
            root = f"{lake.silver.rstrip('/')}/{SILVER}"
            stored = spark.read.schema(_schema(now, SILVER)).option("basePath", root).parquet(*[f"{root}/{f}" for f in files])
            fresh = append_unique(stored.select(*SILVER_KEYS), new, SILVER_KEYS)
        else:
            fresh = keep_first(new, SILVER_KEYS)
        parts = _add(coming, lake.silver, run, SILVER, fresh)
        if not parts:
            return now
        _add_filters(spark, lake, coming, run, parts)
        if RESCUED in staged.columns:
            _add(coming, lake.silver, run, RESCUES, rescued_cells(staged).distinct(), by_day=False)
    return versions.commit(spark, lake.silver, coming)


def _add_filters(spark: SparkSession, lake: Lake, coming: Version, run: str, parts: Sequence[Part], replacing: Sequence[Part] = ()) -> None:
    """Filters of just written silver ``parts``, read back from them."""
    root = f"{lake.silver.rstrip('/')}/{SILVER}"
    stored = spark.read.schema(_schema(coming, SILVER)).option("basePath", root).parquet(*[f"{root}/{p.place}" for p in parts])
    _add(coming, lake.silver, run, FILTERS, build_filters(stored, SILVER_KEYS, TIME), replacing=replacing)


def _small(parts: Iterable[Part], small_bytes: int) -> list[Part]:
    """The small parts of each day that has several, or one of several files that was never packed."""
    by_day: dict[str | None, list[Part]] = {}
    for part in parts:
        if part.size < small_bytes:
            by_day.setdefault(part.day, []).append(part)
    return [p for day in by_day.values() if len(day) > 1 or day[0].files > 1 and day[0].appended for p in day]


def compact_silver(spark: SparkSession, lake: Lake, ts: datetime | None = None, small_bytes: int = SMALL_BYTES) -> Version:
    """Put the small parts of each day together, into files of about the advisory partition size, as one commit.

    A day with two or more parts below ``small_bytes`` is packed; larger parts stay. Only parts that the gold tables
    have taken in are touched, so the next gold run still finds what is new. Readers of the version before go on reading its
    files. With nothing to pack there is no commit, so packing twice changes nothing.
    """
    now, coming, run = _next(spark, lake.silver, ts)
    taken = versions.current(spark, lake.gold).facts.get("silver_seq", 0)
    small = _small((p for p in now.parts.get(SILVER, []) if p.seq <= taken), small_bytes)
    if not small:
        return now
    rows = versions.read_parts(spark, lake.silver, SILVER, small, _schema(now, SILVER))
    new = _add(coming, lake.silver, run, SILVER, rows, appended=False, replacing=small)
    places = {p.place for p in small}
    with scratch_scope(spark):
        old = [p for p in now.parts[FILTERS] if p.place in places]  # filters lie under the same places as their files
        _add_filters(spark, lake, coming, run, new, replacing=old)
    return versions.commit(spark, lake.silver, coming)


def read_silver_rows(spark: SparkSession, lake: Lake) -> DataFrame:
    """The committed silver rows, with their day (the partition column)."""
    return versions.read_table(spark, lake.silver, SILVER)


# --- gold ---------------------------------------------------------------------------------------------------------

def update_gold(spark: SparkSession, lake: Lake, airports: DataFrame | None = None, ts: datetime | None = None) -> Version:
    """L2 to L5 for the silver parts appended since the last gold commit; all tables are committed together.

    Read are the new rows, the state table, and, for aircraft with late rows alone, the days whose rows those change.
    Without new parts there is no commit.
    """
    silver = versions.current(spark, lake.silver)
    now, coming, run = _next(spark, lake.gold, ts)
    taken = now.facts.get("silver_seq", 0)
    fresh = [p for p in silver.parts.get(SILVER, []) if p.appended and p.seq > taken]
    if not fresh:
        return now
    stamp = run_stamp(ts)
    airports = airports if airports is not None else airports_frame(spark)
    new = versions.read_parts(spark, lake.silver, SILVER, fresh, _schema(silver, SILVER))

    def stored(table: str) -> DataFrame | None:
        return versions.read_table(spark, lake.gold, table, now) if table in now.schemas else None

    def stored_days(days: set[str]) -> DataFrame:
        return versions.read_parts(spark, lake.gold, PHASES, versions.of_days(now.parts[PHASES], days), _schema(now, PHASES))

    with scratch_scope(spark):
        edges = materialize(edges_of(new), "lake-edges")
        update: PhaseUpdate = update_phases(new, edges, stored(STATE), stored(EDGES), stored_days)
        gone = [p for p in now.parts.get(PHASES, []) if p.day in update.rewritten]
        rows = update.rows.withColumn("processed_at", F.coalesce("_old_stamp", stamp)).drop("_old_stamp")
        parts = _add(coming, lake.gold, run, PHASES, rows.select(*[c for c in new.columns if c != DAY], "prev_alt", "flight_phase", DAY),
                     replacing=gone)
        _add(coming, lake.gold, run, EDGES, edges)
        state, old_state = latest_of(edges), stored(STATE)
        if old_state is not None:
            state = latest_of(old_state.unionByName(state))
        _add(coming, lake.gold, run, STATE, state, by_day=False, replacing=now.parts.get(STATE, []))
        written = versions.read_parts(spark, lake.gold, PHASES, parts, _schema(coming, PHASES))
        _add(coming, lake.gold, run, PARTIALS, stats.country_partials(written, DAY),
             replacing=[p for p in now.parts.get(PARTIALS, []) if p.day in update.rewritten])
        partials = versions.read_table(spark, lake.gold, PARTIALS, coming)
        _add(coming, lake.gold, run, COUNTRIES, stats.country_stats_from(partials, stamp), by_day=False)
        _add(coming, lake.gold, run, SUMMARY, stats.summary_from(partials, stamp), by_day=False, replacing=now.parts.get(SUMMARY, []))
        near = airport_distance(new.withColumn("processed_at", stamp), airports)
        _add(coming, lake.gold, run, DISTANCES, near, by_day=False)
    coming.facts["silver_seq"] = max(p.seq for p in fresh)
    return versions.commit(spark, lake.gold, coming)


def compact_gold(spark: SparkSession, lake: Lake, ts: datetime | None = None, small_bytes: int = SMALL_BYTES) -> Version:
    """A7 for the tables that grow by day: phases, edges and partial states, put together as one commit.

    Edges of a day merge by aircraft and partial states by country, so what a later run reads of a day no longer grows with
    the runs that wrote it. Tables of a row set per run (statistics, distances) stay as they are. With nothing to
    pack there is no commit.
    """
    now, coming, run = _next(spark, lake.gold, ts)
    merged = {PHASES: lambda rows: rows, EDGES: merge_edges, PARTIALS: lambda rows: stats.merge_partials(rows, DAY)}
    packed = False
    for table, merge in merged.items():
        small = _small(now.parts.get(table, []), small_bytes)
        if small:
            rows = merge(versions.read_parts(spark, lake.gold, table, small, _schema(now, table)))
            _add(coming, lake.gold, run, table, rows, appended=False, replacing=small)
            packed = True
    return versions.commit(spark, lake.gold, coming) if packed else now


def read_gold(spark: SparkSession, lake: Lake, table: str, version: Version | None = None) -> DataFrame:
    """The committed rows of a gold table (``country_stats`` and ``airport_distance``: of every run)."""
    return versions.read_table(spark, lake.gold, table, version)


def latest_run(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The rows that the newest run wrote to a gold table."""
    version = versions.current(spark, lake.gold)
    newest = max(p.seq for p in version.parts[table])
    parts = [p for p in version.parts[table] if p.seq == newest]
    return versions.read_parts(spark, lake.gold, table, parts, _schema(version, table))


def append_landed(spark: SparkSession, raw_dir: str, lake: Lake, ts: datetime | None = None, files_per_commit: int | None = None) -> Version:
    """Silver commits of the landing files that no run before has read.

    A file stream's checkpoint in the silver base remembers the files, so a run opens the new ones alone however
    long the landing zone has grown. ``files_per_commit`` cuts a long backlog into several commits. A run that dies between a commit
    and its checkpoint reads those files again, finds their keys stored and adds nothing.
    """
    rows = rescuing_rows(landed_stream(spark, raw_dir, files_per_commit), run_stamp(ts), source=F.col("_metadata.file_name"))

    def write(batch: DataFrame, batch_id: int) -> None:
        append_silver_run(batch.sparkSession, lake, batch, ts)

    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{lake.silver.rstrip('/')}/{LANDED}")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return versions.current(spark, lake.silver)


def run_hour(spark: SparkSession, raw_dir: str, folder: str, ts: datetime | None = None) -> Lake:
    """New landed snapshots -> silver commit -> gold commit. Rows stored before are passed over by their key."""
    lake = Lake.at(folder)
    append_landed(spark, raw_dir, lake, ts)
    update_gold(spark, lake, ts=ts)
    return lake
