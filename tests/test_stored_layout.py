"""Stored layout: place clustering, pruning by day, files per day, rescued cells, typed sensors, calendar span, stable ties."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.operators import calendar as cal
from flightlake.operators import profile, spatial
from flightlake.operators.geofence import airport_proximity
from flightlake.operators.silver import rescued_cells, rescuing_rows, sensor_values, silver_rows
from flightlake.plans import lake as L
from flightlake.plans.gold import flight_analytics
from flightlake.session import materialize
from flightlake.sources import versions
from flightlake.sources.inline import airports_frame
from flightlake.sources.readers import bronze_from_snapshots, read_layer, read_snapshots
from flightlake.sources.silver_table import append_silver, read_silver
from flightlake.sources.sinks import write_append

TS = datetime(2024, 2, 1)


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def scanned_rows(df):
    """Rows that the file scan of a filter-only plan gave out (row groups passed over do not count)."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()
        return plan.collectLeaves().apply(0).metrics().get("numOutputRows").get().value()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def places(spark, n=20000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), 1.0, 100.0) for i in range(n)]
    rows += [(n, None, 1.0, 1.0, 1.0), (n + 1, float("nan"), 2.0, 1.0, 1.0), (n + 2, 95.0, 2.0, 1.0, 1.0), (n + 3, 90.0, 180.0, 1.0, None)]
    rows += [(n + 4 + i, 51.47, -0.4543, 1.0, 10.0) for i in range(500)]
    return spark.createDataFrame(rows, "event_id long, latitude double, longitude double, velocity double, baro_altitude double")


def test_morton_code_interleaves(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (-90.0, 180.0), (90.0, -180.0), (None, 0.0), (91.0, 0.0)], "latitude double, longitude double")
    assert [r[0] for r in df.select(spatial.morton_code()).collect()] == [0, 2**32 - 1, 0x55555555, 0xAAAAAAAA, None, None]


def test_box_scan_of_a_clustered_table_passes_over_files(spark, tmp_dir):
    df = places(spark)
    df.repartition(16).write.parquet(f"{tmp_dir}/plain")
    spatial.clustered(df, 16).write.parquet(f"{tmp_dir}/clustered")
    plain, clustered = (read_layer(spark, f"{tmp_dir}/{n}") for n in ("plain", "clustered"))
    assert rows_of(clustered.where("not isnan(latitude) or latitude is null")) == rows_of(df.where("not isnan(latitude) or latitude is null"))
    assert clustered.count() == df.count()
    box = profile.bounding_box
    assert rows_of(box(clustered)) == rows_of(box(plain)) and box(plain).count() > 100
    assert scanned_rows(box(clustered)) < 0.5 * scanned_rows(box(plain))
    ports = airports_frame(spark)
    want = rows_of(airport_proximity(plain, ports, 2.0).select("event_id", "code"))
    near = spatial.proximity_pruned(clustered, ports, 2.0).select("event_id", "code")
    assert rows_of(near) == want and len(want) >= 500
    assert rows_of(spatial.proximity_pruned(clustered, ports.limit(0), 2.0).select("event_id")) == []


def test_calendar_join_opens_its_days_only(spark, tmp_dir):
    days = spark.range(0, 6200).withColumn("flight_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 62).cast("int")))
    write_append(days.repartition(8), tmp_dir, ["flight_date"])
    stored = read_layer(spark, tmp_dir)
    assert len(stored.inputFiles()) == 62  # one file a day, from eight partitions
    calendar = materialize(cal.calendar_for(days, "flight_date"), "calendar")
    february = cal.flights_of_days(stored, calendar.where("month_no = 2"))
    assert february.count() == 2900
    plan = february._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    assert rows_of(february.select("id", "date")) == rows_of(days.where("month(flight_date) = 2").select("id", "flight_date"))


def test_calendar_ignores_times_beyond_its_span(spark):
    df = spark.createDataFrame([("2023-05-01 00:00:00",), ("+55999-04-20 10:00:00",), ("0001-01-01 00:00:00",), ("9999-01-01 00:00:00",),
                                ("2024-02-01 00:00:00",), (None,), ("soon",)], "t string")
    got = cal.calendar_for(df, "t")
    assert (got.count(), *got.agg(F.min("date"), F.max("date")).first()) == (365 + 366, datetime(2023, 1, 1).date(), datetime(2024, 12, 31).date())
    assert cal.calendar_for(df.where("t is null"), "t").count() == 0
    assert cal.join_calendar(df, got, "t").where("date is not null").count() == 2


@pytest.mark.parametrize("parts", [(1, 7), (3, 16)])
def test_phases_of_tied_times_are_stable(spark, parts):
    rng = random.Random(2)
    rows = [("a", "x", "Y", f"t{i}", 1.0, 1.0, rng.choice([None, 100.0, 500.0]), 2.0, None, None, None, TS) for i in range(400)]
    df = spark.createDataFrame(rows, schemas.SILVER)
    one, two = (flight_analytics(df.repartition(n).orderBy(F.rand(n)), F.lit("s")) for n in parts)
    assert rows_of(one) == rows_of(two)


def test_append_reads_the_new_rows_own_days(spark, tmp_dir):
    rows = [("a", "x", "Y", str(1704067200 + 86400 * d), 1.0, 1.0, 5.0, 2.0, None, None, None, TS) for d in range(40)]
    append_silver(spark.createDataFrame(rows, schemas.SILVER).repartition(8), tmp_dir)
    stored = read_layer(spark, tmp_dir)
    assert len(stored.inputFiles()) == 40
    odd = [("a", "x", "Y", t, 1.0, 1.0, 5.0, 2.0, None, None, None, TS) for t in ("0", str(1704067200 + 86400 * 39), "x", None)]
    append_silver(spark.createDataFrame(odd, schemas.SILVER), tmp_dir)
    append_silver(spark.createDataFrame(odd, schemas.SILVER), tmp_dir)
    assert read_silver(spark, tmp_dir).count() == 43


def test_rescued_cells_are_the_nulls_that_casts_made(spark, tmp_dir):
    base = ["a", "CS", "Y", "1", "1704067200", "1.5", "2.5", "100", "false", "7", "8", "9", None, "1", "7A0", "false", "0"]
    states = []
    for i, (at, text) in enumerate([(5, "east"), (7, ""), (9, "1e"), (7, None), (11, " 5 "), (8, "bad"), (7, "NaN")]):
        state = [*base]
        state[at], state[4] = text, str(1704067200 + i)
        states.append(state)
    states[0][7] = "high"
    states.append([None] * 17)
    states.append(["a"])
    spark.createDataFrame([(1, states)], schemas.RAW_SNAPSHOT).write.json(f"{tmp_dir}/raw")
    raw = read_snapshots(spark, f"{tmp_dir}/raw")
    stamp = F.lit(TS)
    rows = rescuing_rows(raw, stamp, source=F.col("_metadata.file_name"))
    cells = rescued_cells(rows)
    assert sorted((r.column_name, r.raw_text) for r in cells.collect()) == [
        ("baro_altitude", ""), ("baro_altitude", "high"), ("longitude", "east"), ("velocity", "1e")]
    assert all(r.source_file.endswith(".json") for r in cells.collect())
    plain = silver_rows(raw, stamp)
    assert rows_of(rows.select(*plain.columns)) == rows_of(plain)
    lake = L.run_hour(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake", TS)
    assert versions.read_table(spark, lake.silver, L.RESCUES).count() == 4
    assert L.read_silver_rows(spark, lake).columns == [*plain.columns, "flight_date"]


def test_sensors_come_back_typed(spark):
    cells = ["[1, 22]", "7", "[]", '["a"]', "true", "text", "", None, '{"a": 1}', "1.5", "[1, null]", "null"]
    df = spark.createDataFrame([(1, [["a"] + [None] * 11 + [c]]) for c in cells], schemas.RAW_SNAPSHOT)
    got = {r.sensors: (r.sensors_type, r.sensor_ids) for r in sensor_values(bronze_from_snapshots(df)).collect()}
    assert got["[1, 22]"] == ("ARRAY<BIGINT>", [1, 22]) and got["7"] == ("BIGINT", [7]) and got["[]"][1] == []
    assert got["text"] == got[""] == got[None] == (None, None)
    assert got["true"][0] == "BOOLEAN" and got['{"a": 1}'] == ("OBJECT<a: BIGINT>", None) and got["[1, null]"][1] == [1, None]
