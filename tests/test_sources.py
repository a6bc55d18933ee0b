"""Readers, sinks and literal tables (A1-A13), with the hand-made edge documents of FIXTURES section 3."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightlake.sources import (
    airports_frame,
    bronze_from_snapshots,
    cities_frame,
    read_layer,
    read_snapshots,
    rows_frame,
    snapshot_states,
    with_source_file,
    write_append,
    write_overwrite,
)

STATE_A = ["abc123", "BAW1  ", "United Kingdom", 1700000000, 1700000005, -0.45, 51.47, 1000.5, False,
           120.0, 90, -1.5, None, 1010.0, "7700", False, 0]
STATE_SHORT = ["def456", "        ", "Spain"]
STATE_MIXED = ["ghi789", None, "France", "1700000010", 1700000011, "not-a-number", 48.8, 3000, "true",
               200, 180.5, 0, None, None, None, True, 1]


def _write_docs(path, docs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "snap.json"), "w") as fh:
        for doc in docs:
            fh.write(json.dumps(doc) + "\n")


def _docs():
    return [
        {"time": 1700000000, "states": [STATE_A, STATE_SHORT]},
        {"time": 1700000010, "states": [STATE_MIXED]},
        {"time": 1700000020, "states": None},
    ]


def test_snapshot_scan_explode_and_outer(spark, tmp_dir):
    _write_docs(tmp_dir, _docs())
    raw = read_snapshots(spark, tmp_dir)
    assert raw.count() == 3
    assert snapshot_states(raw).count() == 3
    assert snapshot_states(raw, keep_empty=True).count() == 4


def test_bronze_positions_and_safe_casts(spark, tmp_dir):
    _write_docs(tmp_dir, _docs())
    bronze = bronze_from_snapshots(read_snapshots(spark, tmp_dir))
    rows = {r.icao24: r for r in bronze.collect()}
    a = rows["abc123"]
    assert a.long == -0.45 and a.lat == 51.47 and a.time_position == 1700000000
    assert a.on_ground is False and a.true_track == 90.0 and a.squawk == "7700" and a.position_source == 0
    short = rows["def456"]  # shorter than 17 positions: NULL, not an error
    assert short.callsign == "        " and short.time_position is None and short.position_source is None
    mixed = rows["ghi789"]  # mixed types arrive as text; non-numeric text gives NULL
    assert mixed.long is None and mixed.lat == 48.8 and mixed.on_ground is True and mixed.velocity == 200.0
    assert mixed.time_position == 1700000010


def test_corrupt_record_column(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    with open(os.path.join(tmp_dir, "bad.json"), "w") as fh:
        fh.write('{"time": 1, "states": [["x"]]}\n{not json\n')
    raw = read_snapshots(spark, tmp_dir, corrupt_col="_corrupt").cache()
    assert raw.filter(F.col("_corrupt").isNotNull()).count() == 1
    assert raw.filter(F.col("time") == 1).count() == 1


def test_sinks_overwrite_append_and_lineage(spark, tmp_dir):
    df = spark.range(10).withColumnRenamed("id", "k")
    path = os.path.join(tmp_dir, "t")
    write_overwrite(df, path)
    write_append(df, path)
    assert read_layer(spark, path).count() == 20
    write_overwrite(df, path)
    assert read_layer(spark, path).count() == 10
    files = with_source_file(read_layer(spark, path)).select("source_file").distinct().collect()
    assert all(r.source_file.endswith(".parquet") for r in files)
    assert not any(r.source_file.startswith("_") for r in files)


def test_two_folders_and_glob(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    write_overwrite(spark.range(3), a)
    write_overwrite(spark.range(5), b)
    assert read_layer(spark, a, b).count() == 8
    events = read_layer(spark, "/root/testdata/sf0.001", glob="events.parquet")
    assert events.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_literal_tables(spark):
    airports = airports_frame(spark)
    assert [r.code for r in airports.orderBy("code").collect()] == ["DXB", "JFK", "LHR", "SIN"]
    assert "LocalTableScan" in airports._jdf.queryExecution().executedPlan().toString()
    cities = cities_frame(spark).collect()
    assert {(r.City, r.Lat, r.Lon) for r in cities} == {("London", 51.5, -0.1), ("NYC", 40.7, -74.0)}
    smoke = rows_frame(spark, [("A380", 853), ("B747", 416), ("A320", 180)], "Model STRING, Max_Passengers BIGINT")
    assert smoke.agg(F.sum("Max_Passengers")).first()[0] == 1449
    quoted = rows_frame(spark, [("it's", None)], "a STRING, b DOUBLE").first()
    assert quoted.a == "it's" and quoted.b is None


@pytest.mark.parametrize("n", [0, 1, 1000, 1001])
def test_literal_tables_type_alike_at_any_size(spark, n):
    rows = rows_frame(spark, [(i, f"t{i}", None) for i in range(n)], "x DOUBLE, s STRING, d DATE")
    assert rows.dtypes == [("x", "double"), ("s", "string"), ("d", "date")] and rows.count() == n
    with pytest.raises(pa.lib.ArrowException):
        rows_frame(spark, [("7",)] * max(n, 1), "x DOUBLE")


def test_tables_partitioned_or_not_are_read_together(spark, tmp_dir):
    from flightlake.sources import read_tables, with_source_folder
    a, b = os.path.join(tmp_dir, "stats"), os.path.join(tmp_dir, "summary")
    write_overwrite(spark.createDataFrame([("X", 3, "r1")], "origin_country STRING, flight_count BIGINT, run STRING"), a, ["run"])
    write_overwrite(spark.createDataFrame([(7,)], "total_global_flights BIGINT"), b)
    assert read_layer(spark, a, b, merge_schema=True).count() == 2
    assert with_source_folder(read_layer(spark, a)).first().source_table == "stats"
    assert with_source_folder(read_layer(spark, b)).first().source_table == "summary"
    both = read_tables(spark, {"stats": a, "summary": b})
    rows = {r.source_table: r for r in both.collect()}
    assert set(rows) == {"stats", "summary"}
    assert rows["stats"].flight_count == 3 and rows["stats"].total_global_flights is None
    assert rows["summary"].total_global_flights == 7 and rows["summary"].origin_country is None


def test_only_a_missing_table_counts_as_nothing_stored(spark, tmp_dir):
    from flightlake.sources import read_stored
    assert read_stored(spark, os.path.join(tmp_dir, "none")) is None
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    assert read_stored(spark, bad) is None
    with open(os.path.join(bad, "part-0.parquet"), "w") as fh:
        fh.write("no parquet")
    with pytest.raises(Exception):
        read_stored(spark, bad).count()


def test_pretty_printed_snapshot_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pretty")
    os.makedirs(path)
    with open(os.path.join(path, "snap.json"), "w") as fh:
        json.dump({"time": 1700000000, "states": [STATE_A, STATE_SHORT]}, fh, indent=2)
    raw = read_snapshots(spark, path, multi_line=True)
    assert [r.icao24 for r in bronze_from_snapshots(raw).collect()] == ["abc123", "def456"]
