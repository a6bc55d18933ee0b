"""Report marts (L7): the data behind each report visual, as Spark aggregates.

Top-N selections rank groups by a SUM and keep every group tied at the cut (``rank() <= n``). The
grouped sums (one row per group, combined map-side) are computed once from the state rows and
checkpointed to the shared folder; the cut comes from ``orderBy(desc).limit(n)`` on them (per-task
top-n, then a merge of n rows per task) as a scalar subquery, never from a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flightlake.fixed import DEFAULT_SUM_COLUMNS, TOP_N
from flightlake.functions.columns import safe_cast
from flightlake.operators.joins import broadcast_if_small, semi_join_bounded
from flightlake.session import materialize


def top_groups_by_sum(df: DataFrame, key: str, measure: str, n: int = TOP_N,
                      extra_aggs: Sequence = ()) -> DataFrame:
    """Groups whose ``sum(measure)`` ranks within the top ``n`` (ties at the cut kept).

    Equivalent to ``rank() OVER (ORDER BY s DESC) <= n`` over non-NULL sums: a group has rank <= n
    exactly when its sum is at least the n-th largest sum.
    """
    sums = materialize(
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(measure).alias("_tg_sum"), *extra_aggs), "topn-sums"
    )
    cut = sums.orderBy(F.col("_tg_sum").desc_nulls_last()).limit(n).agg(F.min("_tg_sum")).scalar()
    return sums.filter(F.col("_tg_sum") >= cut)


def aircraft_count(df: DataFrame) -> DataFrame:
    """Distinct aircraft."""
    return df.agg(F.count_distinct("icao24").alias("aircraft"))


def as_of(df: DataFrame, col: str = "processed_at") -> DataFrame:
    """The earliest batch stamp (the report's "as of" card)."""
    return df.agg(F.min(col).alias("as_of"))


def max_altitude_top_countries(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """Max altitude of the ``n`` countries with the largest summed altitude.

    Rank key (SUM) and shown value (MAX) share the grouping key, so both come from one aggregation
    and the semi-join of the report collapses into a filter on the cut.
    """
    top = top_groups_by_sum(df, "origin_country", "baro_altitude", n,
                            extra_aggs=[F.max("baro_altitude").alias("max_altitude")])
    return top.select("origin_country", "max_altitude").orderBy(F.col("max_altitude").desc())


def top_speeders(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """Distinct (velocity, callsign, country) rows of the ``n`` callsigns with the largest summed velocity.

    The top callsigns are a semi-join filter side whose bytes are added up while it is written; it is broadcast
    when they prove it small, so the state rows are filtered where they are read and never shuffled by callsign.
    """
    top = top_groups_by_sum(df, "callsign", "velocity", n)
    states = df.select("velocity", "callsign", "origin_country")
    return semi_join_bounded(states, top, ["callsign"]).distinct().orderBy(F.col("velocity").desc_nulls_last())


def latest_country_stats(stats: DataFrame) -> DataFrame:
    """One stats row per country: the latest ``processed_at`` (stats are appended per run).

    One aggregation, combined map-side; of rows with one stamp the largest by the other columns is kept, so the
    choice is always the same. Stamps that are NULL come before all others.
    """
    rest = [c for c in stats.columns if c not in ("origin_country", "processed_at")]
    latest = F.max(F.struct("processed_at", *rest)).alias("_ls")
    return stats.groupBy("origin_country").agg(latest).select(*[c if c == "origin_country" else F.col(f"_ls.{c}").alias(c)
                                                                for c in stats.columns])


def avg_altitude_by_country(stats: DataFrame) -> DataFrame:
    """Unweighted average of the per-run ``avg_altitude_m`` values per country, largest first."""
    return stats.groupBy("origin_country").agg(F.avg("avg_altitude_m").alias("avg_of_avg_altitude")).orderBy(
        F.col("avg_of_avg_altitude").desc_nulls_last(), "origin_country"
    )


def flights_by_country(stats: DataFrame) -> DataFrame:
    """Summed ``flight_count`` per country, largest first."""
    return stats.groupBy("origin_country").agg(F.sum("flight_count").alias("total_flights")).orderBy(
        F.col("total_flights").desc_nulls_last(), "origin_country"
    )


def map_points(df: DataFrame) -> DataFrame:
    """Summed velocity per map point, NULL shown as zero."""
    return df.groupBy("longitude", "latitude").agg(
        F.coalesce(F.sum("velocity"), F.lit(0.0)).alias("velocity_sum")
    )


def enrich_with_country(flights: DataFrame, stats: DataFrame) -> DataFrame:
    """Many-to-one join of state rows to the latest statistics of their country.

    The stats side (one row per country) is written once to the shared folder, its bytes added up while
    writing; it is broadcast when they prove it small, so the state rows are never shuffled by country (a
    country may hold a large share of them). Beyond the bound it is a shuffled join with AQE skew splitting.
    """
    latest = latest_country_stats(stats).select(
        "origin_country",
        F.col("flight_count").alias("country_flight_count"),
        F.col("avg_speed_ms").alias("country_avg_speed_ms"),
        F.col("count_climbing").alias("country_count_climbing"),
    )
    side, _ = broadcast_if_small(latest, name="latest-country-stats")
    return flights.join(side, "origin_country", "left")


def filter_countries(df: DataFrame, countries: Sequence[str]) -> DataFrame:
    """The slicer's equality filter on country."""
    return df.filter(F.col("origin_country").isin(list(countries)))


def slicer_values(df: DataFrame) -> DataFrame:
    """The list of selectable countries, sorted."""
    return df.select("origin_country").distinct().orderBy("origin_country")


def default_measures(df: DataFrame, key: str = "origin_country",
                     flagged: Sequence[str] = DEFAULT_SUM_COLUMNS) -> DataFrame:
    """Per-group sums of the columns the report sums by default.

    Text columns are summed by what parses as a whole number (the report's declared type for them is BIGINT). A
    flagged column that ``df`` does not have is an error; pass ``flagged`` for tables that hold fewer.
    """
    missing = [c for c in flagged if c not in df.columns]
    if missing:
        raise ValueError(f"columns to sum are missing: {', '.join(missing)}")
    kinds = dict(df.dtypes)
    sums = [F.sum(safe_cast(c, "bigint") if kinds[c] == "string" else F.col(c)).alias(f"sum_{c}") for c in flagged]
    return df.groupBy(key).agg(*sums)
