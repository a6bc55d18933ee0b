"""Gold job (L2-L5): four tables from one silver read. Running it again with one stamp changes nothing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlake.operators.geofence import airport_distance
from flightlake.operators.phase import flight_phase, phase_order
from flightlake.operators.stats import country_stats, daily_summary
from flightlake.session import scratch_scope
from flightlake.sources.inline import airports_frame
from flightlake.sources.readers import read_layer
from flightlake.sources.silver_table import SILVER_PARTITION
from flightlake.sources.sinks import write_overwrite

# Gold tables that keep every run are partitioned by the run's stamp. A run replaces its own folder, so a job that is
# tried again never doubles its rows, and reading one run back opens that folder alone.
RUN_PARTITION = "run"


def _utc(ts: datetime | None) -> datetime:
    ts = ts or datetime.now(timezone.utc)
    return ts.astimezone(timezone.utc).replace(tzinfo=None) if ts.tzinfo else ts


def run_stamp(ts: datetime | None = None) -> Column:
    """One batch stamp for every table of a run (a literal, not ``current_timestamp`` per action)."""
    return F.lit(_utc(ts).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def run_name(ts: datetime | None = None) -> str:
    """The run's partition value: its stamp (UTC) as text that sorts by time."""
    return _utc(ts).strftime("r%Y%m%dT%H%M%S%f")


def write_run(df: DataFrame, path: str, ts: datetime) -> None:
    """Replace the rows that the run stamped ``ts`` has in the table at ``path``; other runs are not touched."""
    write_overwrite(df, f"{path.rstrip('/')}/{RUN_PARTITION}={run_name(ts)}")


def read_run(spark: SparkSession, path: str, ts: datetime) -> DataFrame:
    """The rows of one run of a gold table (partition pruning on the run)."""
    return read_layer(spark, path).filter(F.col(RUN_PARTITION) == F.lit(run_name(ts))).drop(RUN_PARTITION)


def flight_analytics(silver: DataFrame, stamp: Column, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """L2: per-aircraft previous altitude and phase, stamped with the run.

    Rows of one time are ordered by ``time_position`` and then every other column, so the phases are the same
    however the rows are partitioned.
    """
    ties = phase_order(silver.columns)[1:] if tiebreak is None else tiebreak
    return flight_phase(silver, tiebreak=ties).withColumn("processed_at", stamp)


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, airports: DataFrame | None = None,
             ts: datetime | None = None) -> dict[str, str]:
    """Write the four gold tables from the stored silver table; returns their folders.

    ``flight_analytics`` is written first and ``country_stats`` is computed from this run's rows of
    the written table (one partition folder), so the window runs once and a lost executor never
    forces it to be recomputed from scratch.
    """
    ts = _utc(ts)
    stamp = run_stamp(ts)
    airports = airports if airports is not None else airports_frame(spark)
    base = gold_path.rstrip("/")
    # Silver is not cached: each table reads only the columns it needs from parquet (the summary
    # reads none, the geofence four), which costs less than holding every column of silver in
    # executor storage.
    silver = read_layer(spark, silver_path).drop(SILVER_PARTITION)
    with scratch_scope(spark):  # per-run lists and carries are dropped once the tables are written
        write_run(flight_analytics(silver, stamp), f"{base}/flight_analytics", ts)
        write_run(country_stats(read_run(spark, f"{base}/flight_analytics", ts)), f"{base}/country_stats", ts)
        write_overwrite(daily_summary(silver, stamp), f"{base}/daily_summary")
        write_run(airport_distance(silver, airports), f"{base}/airport_distance", ts)
    return {n: f"{base}/{n}" for n in ("flight_analytics", "country_stats", "daily_summary", "airport_distance")}
