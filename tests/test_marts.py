"""Country statistics, profiles and report marts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flightlake.operators import marts, profile
from flightlake.operators.stats import country_stats, daily_summary


def _rows(spark, rows):
    return spark.createDataFrame(
        rows, "icao24 STRING, callsign STRING, origin_country STRING, velocity DOUBLE, baro_altitude DOUBLE, "
              "flight_phase STRING, processed_at TIMESTAMP_NTZ, longitude DOUBLE, latitude DOUBLE"
    )


TS = datetime(2024, 2, 1)


def test_country_stats_and_summary(spark):
    df = _rows(spark, [
        ("a", "A", "UK", 100.0, 1000.0, "Climbing", TS, 0.0, 0.0),
        ("a", "A", "UK", 200.0, None, "Cruising", TS, 0.0, 0.0),
        (None, "B", "FR", None, 500.0, "Climbing", TS, 1.0, 1.0),
    ])
    out = country_stats(df).collect()
    assert [r.origin_country for r in out] == ["UK", "FR"]  # busiest first
    uk, fr = out
    assert (uk.flight_count, uk.avg_speed_ms, uk.count_climbing, uk.avg_altitude_m) == (2, 150.0, 1, 1000.0)
    assert (fr.flight_count, fr.avg_speed_ms, fr.count_climbing) == (0, None, 1)  # count(icao24) skips NULL
    s = daily_summary(df, F.lit(TS)).first()
    assert s.total_global_flights == 3 and s.processed_at == TS


def test_top_n_keeps_ties_at_the_cut(spark):
    # 12 callsigns; sums: c0..c8 distinct and large, then c9, c10, c11 tied at place 10
    rows = []
    for i in range(9):
        rows.append(("x", f"c{i}", "UK", 1000.0 - i, 0.0, None, TS, 0.0, 0.0))
    for name in ("c9", "c10", "c11"):
        rows.append(("x", name, "FR", 10.0, 0.0, None, TS, 0.0, 0.0))
    rows.append(("x", "small", "FR", 1.0, 0.0, None, TS, 0.0, 0.0))
    rows.append(("x", None, "FR", 99999.0, 0.0, None, TS, 0.0, 0.0))  # NULL callsign never ranks
    df = _rows(spark, rows)
    top = {r.callsign for r in marts.top_groups_by_sum(df, "callsign", "velocity", 10).collect()}
    assert top == {f"c{i}" for i in range(12)}
    speeders = marts.top_speeders(df).collect()
    assert {r.callsign for r in speeders} == top and len(speeders) == 12


def test_max_altitude_of_top_countries(spark):
    rows = [("x", "A", f"N{i}", 1.0, float(100 * i), None, TS, 0.0, 0.0) for i in range(15)]
    rows += [("x", "A", "N0", 1.0, 5000.0, None, TS, 0.0, 0.0), ("x", "A", "N0", 1.0, 5000.0, None, TS, 0.0, 0.0)]
    out = {r.origin_country: r.max_altitude for r in marts.max_altitude_top_countries(_rows(spark, rows)).collect()}
    # N0 sums to 10000 -> ranks first although its rows are few; shown value is its MAX
    assert out["N0"] == 5000.0 and len(out) == 10 and "N1" not in out


def test_profile_and_simple_marts(spark):
    df = _rows(spark, [
        ("a", "A", "UK", 100.0, 12000.0, None, TS, 0.0, 40.0),
        ("a", "A", "UK", None, None, None, TS, 0.0, 40.0),
        ("b", "B", "FR", 50.0, 9000.0, None, datetime(2024, 1, 1), 50.0, 80.0),
    ])
    nulls = profile.null_profile(df).first()
    assert nulls.velocity == 1 and nulls.baro_altitude == 1 and nulls.icao24 == 0
    d = profile.describe_stats(df, ["velocity"]).first()
    assert (d.velocity_count, d.velocity_mean, d.velocity_min, d.velocity_max) == (2, 75.0, 50.0, 100.0)
    assert profile.high_flyers(df).count() == 1
    assert profile.bounding_box(df).count() == 2
    assert [tuple(r) for r in profile.top_groups_by_count(df, "origin_country", 1).collect()] == [("UK", 2)]
    assert marts.aircraft_count(df).first().aircraft == 2
    assert marts.as_of(df).first().as_of == datetime(2024, 1, 1)
    pts = {(r.longitude, r.latitude): r.velocity_sum for r in marts.map_points(df).collect()}
    assert pts == {(0.0, 40.0): 100.0, (50.0, 80.0): 50.0}
    assert [r.origin_country for r in marts.slicer_values(df).collect()] == ["FR", "UK"]
    assert marts.filter_countries(df, ["FR"]).count() == 1
    dm = {r.origin_country: r for r in marts.default_measures(df, flagged=["velocity", "baro_altitude"]).collect()}
    assert dm["UK"].sum_velocity == 100.0 and dm["UK"].sum_baro_altitude == 12000.0
    with pytest.raises(ValueError, match="squawk"):
        marts.default_measures(df)
    text = spark.createDataFrame([("UK", "7700"), ("UK", "7A0"), ("FR", None)], "origin_country STRING, squawk STRING")
    got = {r.origin_country: r.sum_squawk for r in marts.default_measures(text, flagged=["squawk"]).collect()}
    assert got == {"UK": 7700, "FR": None}


def test_latest_stats_join(spark):
    stats = spark.createDataFrame([
        ("UK", datetime(2024, 1, 1), 5, 1.0, 1, 10.0), ("UK", datetime(2024, 1, 2), 7, 2.0, 2, 20.0),
        ("FR", datetime(2024, 1, 1), 3, 3.0, 0, 30.0),
    ], "origin_country STRING, processed_at TIMESTAMP_NTZ, flight_count BIGINT, avg_speed_ms DOUBLE, "
       "count_climbing BIGINT, avg_altitude_m DOUBLE")
    flights = spark.createDataFrame([("UK",), ("FR",), ("DE",)], "origin_country STRING")
    out = {r.origin_country: r.country_flight_count for r in marts.enrich_with_country(flights, stats).collect()}
    assert out == {"UK": 7, "FR": 3, "DE": None}
    avg = [(r.origin_country, r.avg_of_avg_altitude) for r in marts.avg_altitude_by_country(stats).collect()]
    assert avg == [("FR", 30.0), ("UK", 15.0)]  # largest first, as the visual sorts
    tot = [(r.origin_country, r.total_flights) for r in marts.flights_by_country(stats).collect()]
    assert tot == [("UK", 12), ("FR", 3)]
    tied = stats.withColumn("processed_at", F.lit(datetime(2024, 1, 5)))
    assert {r.origin_country: r.flight_count for r in marts.latest_country_stats(tied).collect()} == {"UK": 7, "FR": 3}


def test_quality_profile_bundle(spark):
    df = _rows(spark, [("a", "A", "UK", 1.0, 2.0, None, TS, 0.0, 0.0), ("a", "A", "UK", 1.0, 2.0, None, TS, 0.0, 0.0)])
    prof = profile.quality_profile(df, ["icao24", "processed_at"], ["velocity"])
    assert prof["row_count"].first().row_count == 2
    assert prof["duplicates"].first().duplicate_rows == 1
    assert prof["null_counts"].first().flight_phase == 2
    assert prof["preview"].count() == 2
    text = {r.summary: r.velocity for r in profile.describe_text(df, ["velocity"]).collect()}
    assert text["count"] == "2" and text["mean"] == "1.0"


def test_describe_text_columns(spark):
    df = spark.createDataFrame([("7700", 1, True), ("7A0", 2, None), (None, None, None)], "squawk STRING, n INT, flag BOOLEAN")
    assert profile.describable(df) == ["squawk", "n"]
    row = profile.describe_stats(df, profile.describable(df)).first()
    assert (row.squawk_count, row.squawk_mean, row.squawk_stddev, row.squawk_min, row.squawk_max) == (2, 7700.0, None, "7700", "7A0")
    assert {r.summary: r.squawk for r in profile.describe_long(df, ["squawk", "n"]).collect()}["max"] == "7A0"


def test_describe_long_matches_describe(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (4.0, 30.0), (None, 40.0)], "a DOUBLE, b DOUBLE")
    got = {r.summary: (r.a, r.b) for r in profile.describe_long(df, ["a", "b"]).collect()}
    want = {r.summary: (float(r.a), float(r.b)) for r in df.describe().collect()}
    assert set(got) == set(want)
    for stat in got:
        assert all(abs(x - y) < 1e-9 for x, y in zip(got[stat], want[stat])), stat
