"""Geofence (C1, C2, C2b): grid equi-join equals the brute-force pairing; plan has no nested loop."""

import math
import random

from flightlake.operators.geofence import airport_distance, airport_proximity, cell_size
from flightlake.sources.inline import airports_frame


def _flights(spark, rows):
    return spark.createDataFrame(
        rows, "icao24 STRING, callsign STRING, latitude DOUBLE, longitude DOUBLE, baro_altitude DOUBLE"
    )


def _brute(flights, airports, radius):
    out = set()
    for f in flights:
        if f[2] is None or f[3] is None:
            continue
        for a in airports:
            d = math.sqrt(math.pow(f[2] - a[1], 2) + math.pow(f[3] - a[2], 2))
            if d < radius:
                out.add((f[0], a[0]))
    return out


def test_cell_size_is_power_of_two_not_below_radius():
    assert cell_size(0.2) == 0.25 and cell_size(1.0) == 1.0 and cell_size(0.25) == 0.25 and cell_size(3) == 4.0


def test_grid_equals_brute_force(spark):
    rnd = random.Random(3)
    airports = [("A", 51.47, -0.4543, "A"), ("B", 51.6, -0.3, "B"), ("C", -0.1, 179.9, "C"),
                ("D", 0.0, 0.0, "D")]
    rows = []
    for i in range(4000):
        ap = rnd.choice(airports)
        lat = ap[1] + rnd.uniform(-0.6, 0.6)
        lon = ap[2] + rnd.uniform(-0.6, 0.6)
        rows.append((f"f{i}", "X", None if i % 97 == 0 else lat, lon, rnd.choice([None, 2999.0, 3000.0, 9000.0])))
    # boundary rows: on a cell edge, and at a distance of exactly the radius along one axis
    rows += [("edge1", "X", 0.25, 0.0, 1.0), ("edge2", "X", 0.2, 0.0, 1.0), ("edge3", "X", -0.2, 0.0, 1.0),
             ("edge4", "X", 0.0, -0.19999999, 1.0)]
    flights = _flights(spark, rows)
    ap_df = airports_frame(spark, airports)
    for radius in (0.2, 0.5, 0.05):
        got = {(r.icao24, r.code) for r in airport_proximity(flights, ap_df, radius).collect()}
        assert got == _brute(rows, airports, radius)


def test_status_and_two_airports(spark):
    airports = [("P", 10.0, 10.0, "P"), ("Q", 10.1, 10.0, "Q")]
    rows = [("near_both", "X", 10.05, 10.0, 3000.0), ("low", "X", 10.0, 10.0, 2999.0),
            ("nullalt", "X", 10.0, 10.01, None), ("far", "X", 20.0, 20.0, 0.0)]
    out = airport_proximity(_flights(spark, rows), airports_frame(spark, airports)).collect()
    pairs = {(r.icao24, r.code): r.proximity_status for r in out}
    assert pairs == {
        ("near_both", "P"): "Passing Over", ("near_both", "Q"): "Passing Over",
        ("low", "P"): "Landing/Taking Off", ("low", "Q"): "Landing/Taking Off",
        ("nullalt", "P"): "Passing Over", ("nullalt", "Q"): "Passing Over",
    }


def test_plan_is_broadcast_hash_join(spark):
    from pyspark.sql import functions as F

    from flightlake.plans.standin import load_flights
    flights = load_flights(spark, "/root/testdata/sf0.01").withColumn("processed_at", F.current_timestamp())
    plan = airport_distance(flights, airports_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin [_gf_clat" in plan
