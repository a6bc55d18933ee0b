"""End-to-end run (L8, L1-L5, A6-A8) and the incremental stream."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flightlake.operators.silver import silver_rows, to_silver
from flightlake.plans.pipeline import run, run_incremental, silver_folder
from flightlake.plans.standin import load_flights, states_from_flights
from flightlake.sources.readers import read_layer, read_snapshots
from flightlake.sources.silver_table import read_silver
from flightlake.streaming.incremental import dedupe_stream, run_available_now, silver_rows_stream

SF = "/root/testdata/sf0.001"


def test_pipeline_end_to_end_is_repeat_safe(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    states_from_flights(load_flights(spark, SF)).write.json(raw)
    expected = to_silver(read_snapshots(spark, raw)).count()
    out = os.path.join(tmp_dir, "lake")
    paths = run(spark, raw, out, ts=datetime(2024, 2, 1))
    silver = read_layer(spark, os.path.join(out, "silver", "cleaned_flights"))
    assert silver.count() == expected
    assert silver.groupBy("icao24", "time_position").count().filter("count > 1").count() == 0
    gold = {n: read_layer(spark, p) for n, p in paths.items()}
    assert gold["flight_analytics"].count() == expected
    assert gold["daily_summary"].first().total_global_flights == expected
    stats = gold["country_stats"]
    assert stats.agg(F.sum("flight_count")).first()[0] == expected
    assert stats.select("processed_at").distinct().count() == 1
    # second run on the same landing zone: silver gains nothing; gold appends one more run
    run(spark, raw, out, ts=datetime(2024, 2, 2))
    assert read_layer(spark, os.path.join(out, "silver", "cleaned_flights")).count() == expected
    assert read_layer(spark, paths["country_stats"]).select("processed_at").distinct().count() == 2
    assert read_layer(spark, paths["daily_summary"]).count() == 1  # overwritten each run
    # one run's rows are read back from their own partition folder only
    from flightlake.plans.gold import read_run
    first = read_run(spark, paths["flight_analytics"], datetime(2024, 2, 1))
    assert first.count() == expected
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run#" in plan
    assert "flight_date" not in first.columns
    # a run that is tried again with its stamp replaces its rows
    run(spark, raw, out, ts=datetime(2024, 2, 2))
    assert read_layer(spark, paths["country_stats"]).agg(F.sum("flight_count")).first()[0] == 2 * expected
    assert read_layer(spark, paths["flight_analytics"]).count() == 2 * expected


def _write(path, name, docs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for d in docs:
            fh.write(json.dumps(d) + "\n")


def _state(icao, t, callsign="CS"):
    return [icao, callsign, "X", t, t, 1.0, 2.0, 100.0, False, 50.0, 0.0, 0.0]


def test_bounded_stream_dedupes_across_triggers(spark, tmp_dir):
    raw, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "silver", "ckpt"))

    def trigger():
        rows = silver_rows_stream(spark, raw)
        timed = rows.withColumn("event_time", F.timestamp_seconds(F.col("time_position").try_cast("bigint")))
        run_available_now(dedupe_stream(timed, ["icao24", "time_position"], "event_time", "2 hours"), sink, ckpt)
        return sorted((r.icao24, r.time_position) for r in read_layer(spark, sink).collect())

    _write(raw, "a.json", [{"time": 1700000000, "states": [_state("a1", 1700000000), _state("a2", 1700000000)]}])
    assert len(trigger()) == 2
    # the same key lands again in a later file, with one new key
    _write(raw, "b.json", [{"time": 1700000060, "states": [_state("a1", 1700000000), _state("a3", 1700000060)]}])
    assert trigger() == [("a1", "1700000000"), ("a2", "1700000000"), ("a3", "1700000060")]
    assert len(trigger()) == 3  # nothing new: a third trigger adds nothing


@pytest.mark.parametrize("jobs", [("run", "inc", "run"), ("inc", "run", "inc")])
def test_mixed_runs_store_every_row_once(spark, tmp_dir, jobs):
    """Batch and incremental runs on one lake, with a new key three hours late: nothing is lost, hidden or doubled."""
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "lake")
    now = 1700000000
    landings = [[_state("a1", now), _state("a2", now)], [_state("a2", now), _state("a3", now + 60), _state("n1", None)],
                [_state("late", now - 3 * 3600), _state("a3", now + 60), _state("n1", None)]]
    for day, (job, states) in enumerate(zip(jobs, landings), 1):
        _write(raw, f"{day}.json", [{"time": now, "states": states}])
        paths = {"run": run, "inc": run_incremental}[job](spark, raw, out, ts=datetime(2024, 2, day))
    got = sorted(r.icao24 for r in read_silver(spark, silver_folder(out)).collect())
    assert got == ["a1", "a2", "a3", "late", "n1"]
    assert read_layer(spark, paths["daily_summary"]).first().total_global_flights == 5


def test_incremental_pipeline_reads_only_new_files(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "lake")
    _write(raw, "a.json", [{"time": 1700000000, "states": [_state("a1", 1700000000), _state("a2", 1700000000)]}])
    paths = run_incremental(spark, raw, out, ts=datetime(2024, 2, 1))
    silver = os.path.join(out, "silver", "cleaned_flights")
    assert read_layer(spark, silver).count() == 2
    assert read_layer(spark, paths["daily_summary"]).first().total_global_flights == 2
    # a later landing file repeats one key and adds one; the old file is not read again
    _write(raw, "b.json", [{"time": 1700000060, "states": [_state("a2", 1700000000), _state("a3", 1700000060)]}])
    run_incremental(spark, raw, out, ts=datetime(2024, 2, 2))
    assert sorted(r.icao24 for r in read_layer(spark, silver).collect()) == ["a1", "a2", "a3"]
    assert read_layer(spark, paths["daily_summary"]).first().total_global_flights == 3


def test_gold_run_removes_its_intermediates(spark, tmp_dir):
    from flightlake.plans.gold import run_gold
    from flightlake.session import checkpoint_root
    silver = os.path.join(tmp_dir, "silver")
    load_flights(spark, SF).withColumn("processed_at", F.current_timestamp()).write.parquet(silver)
    root = checkpoint_root(spark)
    before = set(os.listdir(root))
    run_gold(spark, silver, os.path.join(tmp_dir, "gold"), ts=datetime(2024, 2, 1))
    assert not [d for d in set(os.listdir(root)) - before if d.startswith("lag-")]
    countries = load_flights(spark, SF).select("origin_country").distinct().count()
    assert read_layer(spark, os.path.join(tmp_dir, "gold", "country_stats")).count() == countries


def test_exact_stream_keeps_smallest_row_and_is_replay_safe(spark, tmp_dir):
    from flightlake.streaming.incremental import append_silver_batches, run_exact_available_now
    raw = os.path.join(tmp_dir, "raw")
    sink, ckpt = os.path.join(tmp_dir, "silver"), os.path.join(tmp_dir, "ckpt")
    # one key twice inside the same file, with different callsigns: the smaller one survives
    _write(raw, "a.json", [{"time": 1700000000, "states": [_state("a1", 1700000000, "ZZ"),
                                                             _state("a1", 1700000000, "AA"),
                                                             _state("a2", 1700000000)]}])
    run_exact_available_now(silver_rows_stream(spark, raw), sink, ckpt)
    got = {(r.icao24, r.callsign) for r in read_layer(spark, sink).collect()}
    assert got == {("a1", "AA"), ("a2", "CS")}
    _write(raw, "b.json", [{"time": 1700000060, "states": [_state("a1", 1700000000, "BB"),
                                                             _state("a3", 1700000060)]}])
    run_exact_available_now(silver_rows_stream(spark, raw), sink, ckpt)
    assert sorted(r.icao24 for r in read_layer(spark, sink).collect()) == ["a1", "a2", "a3"]
    # a replayed micro-batch (at-least-once sink) adds nothing
    batch = silver_rows(read_snapshots(spark, raw))
    append_silver_batches(sink)(batch, 7)
    assert read_layer(spark, sink).count() == 3
    # a key with a NULL time, landed twice in later files, is stored once (outside any time range)
    _write(raw, "c.json", [{"time": 1700000120, "states": [_state("n1", None)]}])
    run_exact_available_now(silver_rows_stream(spark, raw), sink, ckpt)
    _write(raw, "d.json", [{"time": 1700000180, "states": [_state("n1", None), _state("a4", 1700000180)]}])
    run_exact_available_now(silver_rows_stream(spark, raw), sink, ckpt)
    assert sorted(r.icao24 for r in read_layer(spark, sink).collect()) == ["a1", "a2", "a3", "a4", "n1"]
