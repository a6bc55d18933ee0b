"""Previous altitude and flight phase (E1, E2): edge rows and equality with the plain window."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from flightlake.operators.phase import flight_phase, lag_by_key

T0 = datetime(2024, 1, 1)


def _flights(spark, rows):
    return spark.createDataFrame(rows, "icao24 STRING, flight_time TIMESTAMP_NTZ, eid BIGINT, baro_altitude DOUBLE")


def test_phase_edge_rows(spark):
    alts = [1000.0, 1015.0, 1000.0, 1015.01, None, 990.0, 974.99, 974.99]
    rows = [("a", T0 + timedelta(minutes=20 * i), i, alt) for i, alt in enumerate(alts)]
    out = flight_phase(_flights(spark, rows), tiebreak=["eid"]).orderBy("eid").collect()
    assert [r.flight_phase for r in out] == [
        "Initializing",   # first row
        "Cruising",       # exactly +15
        "Cruising",       # exactly -15
        "Climbing",       # +15.01
        "Cruising",       # NULL current, known previous
        "Initializing",   # NULL previous
        "Descending",     # -15.01
        "Cruising",
    ]
    assert out[1].prev_alt == 1000.0 and out[5].prev_alt is None


def _plain(df, value="baro_altitude"):
    w = Window.partitionBy("icao24").orderBy("flight_time", "eid")
    return df.withColumn("prev_alt", F.lag(value).over(w))


def test_split_lag_equals_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    for eid in range(3000):
        key = rnd.choice(["hot"] * 6 + ["b", "c", None])  # one hot key with most rows, and NULL keys
        t = None if rnd.random() < 0.02 else T0 + timedelta(seconds=rnd.randrange(0, 3 * 86400))
        alt = None if rnd.random() < 0.05 else float(rnd.randrange(0, 12000))
        rows.append((key, t, eid, alt))
    df = _flights(spark, rows)
    want = sorted(map(tuple, _plain(df).collect()), key=lambda r: r[2])
    for hot in (10**9, 1000, 300, 40):
        got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt", hot)
        assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want, hot


def test_hot_key_is_split_by_range(spark):
    """One aircraft holds most rows inside a few minutes (many equal times); its rows are cut into parts."""
    rnd = random.Random(11)
    rows = []
    for eid in range(4000):
        key = rnd.choice(["hot"] * 8 + ["b", None])
        t = None if rnd.random() < 0.01 else T0 + timedelta(seconds=rnd.randrange(0, 600))
        alt = None if rnd.random() < 0.05 else float(rnd.randrange(0, 12000))
        rows.append((key, t, eid, alt))
    df = _flights(spark, rows)
    want = sorted(map(tuple, _plain(df).collect()), key=lambda r: r[2])
    got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt", hot_rows=100)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the hot rows are read back from their written range parts and windowed per (key, part)
    assert "lag-hot-rows" in plan
    assert re.search(r"windowspecdefinition\(_lg_k#\d+, _lg_p#\d+", plan)


def test_small_parts_share_range_tasks(spark):
    """Many parts make few tasks and files; each part is still a range of one order of at most ``hot_rows`` rows."""
    rnd = random.Random(5)
    rows = [(f"k{i % 60}", T0 + timedelta(seconds=rnd.randrange(0, 900)), i, float(rnd.randrange(0, 12000))) for i in range(4000)]
    df = _flights(spark, rows)
    got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt", hot_rows=10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _plain(df).collect()))
    files = [f for f in got.inputFiles() if "lag-hot-rows" in f]
    assert 1 <= len(files) <= 8  # 400 parts
    parts = spark.read.parquet(*files).groupBy("_lg_p").agg(F.count("eid").alias("n"), F.min("_lg_i").alias("a"), F.max("_lg_i").alias("b"))
    held = parts.orderBy("_lg_p").collect()
    assert len(held) >= 400 and max(r.n for r in held) <= 10 and sum(r.n for r in held) == 4000
    assert all(x.b < y.a for x, y in zip(held, held[1:]))


def test_lag_with_nan_and_null_order_keys(spark):
    """NaN sorts after every number and NULL before, on both routes."""
    order = [None, -1.0, 0.0, 5.0, float("inf"), float("nan")]
    rows = [(k, order[i % 6], i, float(i)) for i, k in enumerate(["hot"] * 60 + ["cold"] * 6)]
    df = spark.createDataFrame(rows, "icao24 STRING, flight_time DOUBLE, eid BIGINT, baro_altitude DOUBLE")
    want = sorted((r.eid, r.prev_alt) for r in _plain(df).collect() if r.prev_alt is not None)
    for hot in (10**9, 7):
        got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt", hot).collect()
        assert sorted((r.eid, r.prev_alt) for r in got if r.prev_alt is not None) == want, hot


def test_split_lag_on_text_time(spark):
    rows = [("a", f"2024-01-0{1 + i % 3} {i % 24:02d}:00:00", i, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "icao24 STRING, flight_time STRING, eid BIGINT, baro_altitude DOUBLE")
    for hot in (10**9, 9):
        got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt", hot)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _plain(df).collect()))


def test_phase_counts_sum_to_rows(spark):
    from flightlake.plans.standin import load_flights
    flights = load_flights(spark, "/root/testdata/sf0.01")
    phased = flight_phase(flights, tiebreak=["event_id"])
    counts = {r.flight_phase: r["count"] for r in phased.groupBy("flight_phase").count().collect()}
    assert counts == {"Climbing": 4630, "Cruising": 320, "Descending": 4653, "Initializing": 397}


def test_lag_on_empty_input(spark):
    df = _flights(spark, [])
    got = lag_by_key(df, ["icao24"], ["flight_time", "eid"], "baro_altitude", "prev_alt")
    assert got.collect() == [] and got.columns == ["icao24", "flight_time", "eid", "baro_altitude", "prev_alt"]
    assert flight_phase(df, tiebreak=["eid"]).count() == 0
