"""Physical-plan properties the scale design relies on."""

import os
import re

from pyspark.sql import functions as F

from flightlake.operators import marts, profile
from flightlake.operators.phase import flight_phase
from flightlake.operators.stats import country_stats
from flightlake.plans.standin import load_flights
from flightlake.sources.readers import read_layer

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _silver_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver")
    load_flights(spark, SF).write.parquet(path)
    return read_layer(spark, path)


def test_filters_and_columns_reach_the_scan(spark, tmp_dir):
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(profile.high_flyers(silver).select("icao24", "baro_altitude"))
    assert "GreaterThan(baro_altitude,10000.0)" in plan
    read_schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert read_schema == "struct<icao24:string,baro_altitude:double>"
    box = plan_of(profile.bounding_box(silver).select("event_id"))
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), GreaterThanOrEqual(latitude,35.0)" in box
    assert "ReadSchema: struct<event_id:bigint,latitude:double,longitude:double>" in box


def test_phase_without_hot_keys_is_one_exchange_and_one_sort(spark, tmp_dir):
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(flight_phase(silver, tiebreak=["event_id"]))
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "SortAggregate" not in plan and "Join" not in plan and "SinglePartition" not in plan


def test_hot_keys_are_counted_by_hash_aggregation(spark, tmp_dir):
    """The list of hot keys reads the key column alone and adds up counts before the shuffle."""
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(silver.groupBy("icao24").agg(F.count(F.lit(1)).alias("n")).filter("n > 5"))
    assert "partial_count" in plan and "SortAggregate" not in plan and "ReadSchema: struct<icao24:string>" in plan


def test_rollup_expands_days_not_rows(spark, tmp_dir):
    from flightlake.operators.calendar import calendar_for, rollup_by_date
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(rollup_by_date(silver, calendar_for(silver, "flight_time"), "flight_time"))
    assert plan.index("Expand") < plan.index("partial_count(1)")  # the count per day runs below the Expand


def test_silver_append_prunes_stored_partitions(spark, tmp_dir):
    from flightlake.sources.readers import read_stored
    from flightlake.sources.silver_table import append_silver, flight_date
    path = os.path.join(tmp_dir, "silver")
    rows = load_flights(spark, SF).withColumn("time_position", F.col("time_position").cast("string"))
    append_silver(rows, path)
    stored = read_stored(spark, path)
    assert stored.count() == rows.select("icao24", "time_position").distinct().count()
    assert stored.select("flight_date").distinct().count() > 5
    seen = stored.filter(F.col("flight_date").isNull() | F.col("flight_date").between("2024-01-02", "2024-01-03"))
    plan = plan_of(seen.select("icao24", "time_position"))
    assert re.search(r"PartitionFilters: \[.*flight_date", plan) and "ReadSchema: struct<icao24:string,time_position:string>" in plan
    odd = spark.createDataFrame([("1e99",), ("99999999999999999",), ("-5",), (None,), ("0",)], "time_position STRING")
    assert [str(r[0]) for r in odd.select(flight_date()).collect()] == ["None", "None", "1969-12-31", "None", "1970-01-01"]


def test_broadcast_bound_is_in_bytes(spark):
    from flightlake.operators.joins import broadcast_if_small
    df = spark.createDataFrame([("x" * 5000,)] * 20, "s STRING")
    assert broadcast_if_small(df, 200_000)[1] and not broadcast_if_small(df, 50_000)[1]
    assert broadcast_if_small(df.limit(0), 0)[1]


def test_country_stats_is_partial_then_final_hash_aggregate(spark, tmp_dir):
    silver = _silver_table(spark, tmp_dir).withColumn("processed_at", F.current_timestamp())
    phased = flight_phase(silver, tiebreak=["event_id"])
    plan = plan_of(country_stats(phased))
    assert "partial_count" in plan and "partial_avg" in plan


def test_top_n_uses_no_global_window_and_a_broadcast_semi_join(spark, tmp_dir):
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(marts.top_speeders(silver))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert "Window" not in plan
    cut = plan_of(marts.top_groups_by_sum(silver, "callsign", "velocity"))
    assert "TakeOrderedAndProject" in cut and "Window" not in cut


def test_top_groups_by_count_is_take_ordered(spark, tmp_dir):
    silver = _silver_table(spark, tmp_dir)
    plan = plan_of(profile.top_groups_by_count(silver, "origin_country"))
    assert "TakeOrderedAndProject" in plan


def test_no_local_checkpoint_folder_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from flightlake.session import checkpoint_root
    for master in ("yarn", "local-cluster[2,1,512]"):
        stub = SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: default),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
        )
        with pytest.raises(RuntimeError, match="shared folder"):
            checkpoint_root(stub)


def test_materialize_counted_observes_exact_rows(spark):
    from flightlake.session import materialize_counted
    written, rows = materialize_counted(spark.range(1234).filter("id % 3 = 0"), "count-test")
    assert rows == 412 and written.count() == 412
    empty, none = materialize_counted(spark.range(5).filter("id > 9"), "count-test")
    assert none == 0 and empty.count() == 0
