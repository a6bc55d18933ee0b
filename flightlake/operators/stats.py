"""Gold aggregates: country statistics (D1-D3) and the global summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.fixed import PHASE_CLIMBING

# Registers (log2) of an aircraft sketch: at most 4 KB a country and day.
SKETCH_LOG2 = 12


def country_stats(phased: DataFrame, country: str = "origin_country", stamp: str = "processed_at") -> DataFrame:
    """Rows, mean speed, climbing rows and mean altitude per (country, batch stamp), busiest first.

    One hash aggregation (partial per task, final after the shuffle of partial rows), so a country
    holding most rows costs no more than any other. The final sort runs on one row per group.
    """
    return (
        phased.groupBy(country, stamp)
        .agg(
            F.count("icao24").alias("flight_count"),
            F.avg("velocity").alias("avg_speed_ms"),
            F.count_if(F.col("flight_phase") == F.lit(PHASE_CLIMBING)).alias("count_climbing"),
            F.avg("baro_altitude").alias("avg_altitude_m"),
        )
        .orderBy(F.col("flight_count").desc(), F.col(country).asc_nulls_first())
    )


def daily_summary(flights: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One row: the batch stamp and the number of stored state rows (global aggregate, no groupBy)."""
    stamp = run_ts if run_ts is not None else F.current_timestamp()
    return flights.select(stamp.alias("processed_at"), F.count(F.lit(1)).alias("total_global_flights"))


def country_partials(phased: DataFrame, day: str, country: str = "origin_country") -> DataFrame:
    """Mergeable state of the statistics per country and day: counts, sums, and a sketch of the aircraft.

    States of different rows add up, so a run makes those of the rows it wrote and reads no others.
    """
    return phased.groupBy(country, day).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("icao24").alias("flights"),
        F.sum("velocity").alias("speed_sum"), F.count("velocity").alias("speed_n"),
        F.count_if(F.col("flight_phase") == F.lit(PHASE_CLIMBING)).alias("climbing"),
        F.sum("baro_altitude").alias("altitude_sum"), F.count("baro_altitude").alias("altitude_n"),
        F.hll_sketch_agg("icao24", F.lit(SKETCH_LOG2)).alias("aircraft"))


def merge_partials(partials: DataFrame, day: str, country: str = "origin_country") -> DataFrame:
    """Partial states of several runs as one row per country and day: sums added up, sketches united."""
    sums = [F.sum(c).alias(c) for c in ("row_count", "flights", "speed_sum", "speed_n", "climbing", "altitude_sum", "altitude_n")]
    return partials.groupBy(country, day).agg(*sums, F.hll_union_agg("aircraft").alias("aircraft"))


def country_stats_from(partials: DataFrame, stamp: Column, country: str = "origin_country") -> DataFrame:
    """``country_stats`` of all rows behind some partial states, stamped."""
    return partials.groupBy(country).agg(
        F.sum("flights").alias("flight_count"), F.try_divide(F.sum("speed_sum"), F.sum("speed_n")).alias("avg_speed_ms"),
        F.sum("climbing").alias("count_climbing"), F.try_divide(F.sum("altitude_sum"), F.sum("altitude_n")).alias("avg_altitude_m"),
    ).select(country, stamp.alias("processed_at"), "flight_count", "avg_speed_ms", "count_climbing", "avg_altitude_m")


def summary_from(partials: DataFrame, stamp: Column) -> DataFrame:
    """``daily_summary`` of all rows behind some partial states."""
    return partials.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_global_flights")).select(
        stamp.alias("processed_at"), "total_global_flights")


def aircraft_estimate(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D11, approximate: distinct aircraft of the rows behind some partial states (filter them by day or country first).

    Sketches of 2^12 registers: the relative standard error is 1.04 / sqrt(4096), 1.6 %. ``marts.aircraft_count`` is the exact form.
    """
    return partials.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("aircraft")).alias("aircraft"))
