"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per implemented operator.

Every query reads the driver's tables (through the stand-in ``flights`` rows) in full. Computed
doubles are rounded to 6 decimals so results compare across engines; the matching SQL lives in
``plans.oracles`` under the same names and column aliases.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flightlake.operators import calendar as cal
from flightlake.operators import marts, profile, spatial, stats
from flightlake.operators.dedupe import append_unique, duplicate_count, keep_first
from flightlake.operators.geofence import airport_distance
from flightlake.operators.phase import flight_phase
from flightlake.operators.silver import report_silver, sensor_values, to_silver
from flightlake.operators.stats import country_stats, daily_summary
from flightlake.plans import lake
from flightlake.plans.gold import RUN_PARTITION
from flightlake.plans.pipeline import run as run_pipeline
from flightlake.plans.pipeline import run_bronze, run_incremental, silver_folder
from flightlake.sources.sinks import write_overwrite
from flightlake.plans.standin import load_flights, load_tables, states_from_flights
from flightlake.session import materialize, scratch_path
from flightlake.sources import versions
from flightlake.sources.inline import airports_frame
from flightlake.sources.readers import (
    bronze_from_snapshots,
    read_layer,
    read_snapshots,
    read_tables,
    with_source_file,
)
from flightlake.sources.silver_table import append_silver, read_silver
from flightlake.streaming.incremental import (
    dedupe_stream,
    run_available_now,
    run_exact_available_now,
    silver_rows_stream,
)

# Batch stamp used by every registered query (a run parameter; zone-free so both engines agree).
RUN_TS = "2024-02-01 00:00:00"
# Epoch seconds that part the landings of the incremental queries.
LANDING_CUT = 1705000000
SLICER_COUNTRIES = ["NATION_0", "NATION_1"]


def stamp() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def r6(c: str) -> Column:
    return F.round(F.col(c), 6).alias(c)


def _phased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_phase(load_flights(spark, sf_dir), tiebreak=["event_id"]).withColumn("processed_at", stamp())


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_stats(_phased(spark, sf_dir))


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of two runs: an earlier one over the flights before the cut, and the run of ``_stats``."""
    before = load_flights(spark, sf_dir).filter(F.col("time_position") < F.lit(LANDING_CUT))
    earlier = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    first = country_stats(flight_phase(before, tiebreak=["event_id"]).withColumn("processed_at", earlier))
    return first.unionByName(_stats(spark, sf_dir))


def q_flight_phase(spark, sf_dir):
    return _phased(spark, sf_dir).select(
        "event_id", "icao24", "flight_time", "baro_altitude", "prev_alt", "flight_phase"
    )


def q_flight_phase_split(spark, sf_dir):
    """E1/E2 through the hot-key path on the whole table: a 50-row threshold, so most aircraft (about 67 rows
    each) are cut into range parts and the rest stay on the cold path. Must equal ``flight_phase`` row for row."""
    phased = flight_phase(load_flights(spark, sf_dir), tiebreak=["event_id"], hot_rows=50)
    return phased.select("event_id", "icao24", "flight_time", "baro_altitude", "prev_alt", "flight_phase")


def q_country_stats(spark, sf_dir):
    return _stats(spark, sf_dir).select(
        "origin_country", "processed_at", "flight_count", r6("avg_speed_ms"), "count_climbing", r6("avg_altitude_m")
    )


def q_daily_summary(spark, sf_dir):
    return daily_summary(load_flights(spark, sf_dir), stamp())


def q_geofence(spark, sf_dir):
    flights = load_flights(spark, sf_dir).withColumn("processed_at", stamp())
    out = airport_distance(flights, airports_frame(spark))
    return out.select("icao24", "callsign", "airport_name", r6("dist"), "proximity_status", "flight_time",
                      "processed_at")


def q_geofence_wide(spark, sf_dir):
    """Same operator with a 1-degree radius: many matches around each of the four airports."""
    flights = load_flights(spark, sf_dir).withColumn("processed_at", stamp())
    out = airport_distance(flights, airports_frame(spark), radius=1.0)
    return out.select("icao24", "callsign", "airport_name", r6("dist"), "proximity_status", "flight_time",
                      "processed_at")


def q_silver_clean(spark, sf_dir):
    return to_silver(states_from_flights(load_flights(spark, sf_dir)), stamp())


def q_silver_strict(spark, sf_dir):
    """B9 + optional blank filter: the README's NULL-coordinate rule and blank callsigns removed."""
    states = states_from_flights(load_flights(spark, sf_dir))
    return to_silver(states, stamp(), drop_blank=True, drop_null_coords=True)


def q_high_flyer_count(spark, sf_dir):
    """B10 + D6: the notebook's count of rows above the cruising threshold, as a one-row frame."""
    return profile.row_count(profile.high_flyers(load_flights(spark, sf_dir)))


def q_silver_from_json(spark, sf_dir):
    """A1 + A6 + L1: snapshots written as JSON text to the shared folder, read back with the fixed schema."""
    path = scratch_path(spark, "snapshots-json")
    states_from_flights(load_flights(spark, sf_dir)).write.mode("overwrite").json(path)
    return to_silver(read_snapshots(spark, path), stamp())


def q_bronze_layer(spark, sf_dir):
    """A15 + A6 + A5: snapshots landed as JSON, bronze job writes parquet, read back."""
    raw = scratch_path(spark, "landing")
    states_from_flights(load_flights(spark, sf_dir)).write.mode("overwrite").json(raw)
    bronze = scratch_path(spark, "bronze")
    run_bronze(spark, raw, bronze)
    return read_layer(spark, bronze)


def _gold_twice(spark, sf_dir) -> dict[str, str]:
    """Landed JSON -> silver (append-unique) -> gold tables on disk, the whole job run twice with one stamp (a
    retry): the stored tables must hold the run once. Returns their folders."""
    raw, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    states_from_flights(load_flights(spark, sf_dir)).write.mode("overwrite").json(raw)
    run_pipeline(spark, raw, lake, ts=datetime(2024, 2, 1))
    return run_pipeline(spark, raw, lake, ts=datetime(2024, 2, 1))


def _stored(spark, path: str) -> DataFrame:
    rows = read_layer(spark, path).drop(RUN_PARTITION)
    return rows.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


def q_pipeline_country_stats(spark, sf_dir):
    """L4: the stored country statistics after a retried run."""
    return _stored(spark, _gold_twice(spark, sf_dir)["country_stats"]).select(
        "origin_country", "processed_at", "flight_count", r6("avg_speed_ms"), "count_climbing", r6("avg_altitude_m"))


def q_gold_flight_analytics(spark, sf_dir):
    """L2: the stored phases after a retried run."""
    rows = _stored(spark, _gold_twice(spark, sf_dir)["flight_analytics"])
    return rows.withColumns({c: F.round(F.col(c), 6) for c in ("longitude", "latitude", "velocity")})


def q_gold_airport_distance(spark, sf_dir):
    """L3: the stored airport distances after a retried run."""
    return _stored(spark, _gold_twice(spark, sf_dir)["airport_distance"]).withColumn("dist", r6("dist"))


def q_gold_daily_summary(spark, sf_dir):
    """The stored summary after a retried run."""
    return _stored(spark, _gold_twice(spark, sf_dir)["daily_summary"])


def q_describe_bronze(spark, sf_dir):
    """D7 over every number and text column of bronze (what a notebook's ``describe`` covers), a row per column."""
    bronze = bronze_from_snapshots(states_from_flights(load_flights(spark, sf_dir))).drop("snapshot_time")
    columns, kinds = profile.describable(bronze), dict(bronze.dtypes)
    wide = profile.describe_stats(bronze, columns)

    def bound(c: str, stat: str, text: bool):
        if (kinds[c] == "string") != text:
            return F.lit(None).cast("string" if text else "double")
        return F.col(f"{c}_{stat}") if text else F.round(F.col(f"{c}_{stat}").cast("double"), 6)

    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_count").alias("n"), F.round(f"{c}_mean", 3).alias("mean"),
                     F.round(f"{c}_stddev", 3).alias("stddev"),
                     *[bound(c, s, False).alias(f"{s}_number") for s in ("min", "max")],
                     *[bound(c, s, True).alias(f"{s}_text") for s in ("min", "max")]) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def q_states_explode(spark, sf_dir):
    return bronze_from_snapshots(states_from_flights(load_flights(spark, sf_dir)))


def q_dedupe(spark, sf_dir):
    flights = load_flights(spark, sf_dir)
    return keep_first(flights.unionByName(flights), ["icao24", "time_position"], ["event_id"])


def q_null_profile(spark, sf_dir):
    return profile.null_profile(load_flights(spark, sf_dir))


def q_describe_stats(spark, sf_dir):
    df = profile.describe_stats(load_flights(spark, sf_dir), ["baro_altitude", "velocity"])
    return df.select(*[r6(c) if c.endswith(("_mean", "_stddev")) else F.col(c) for c in df.columns])


def q_dup_count(spark, sf_dir):
    return duplicate_count(load_flights(spark, sf_dir), ["icao24", "time_position"])


def q_high_flyers(spark, sf_dir):
    return profile.high_flyers(load_flights(spark, sf_dir)).select(
        "event_id", "icao24", "callsign", "origin_country", "baro_altitude"
    )


def q_europe_box(spark, sf_dir):
    return profile.bounding_box(load_flights(spark, sf_dir)).select("event_id", "latitude", "longitude")


def q_top_countries(spark, sf_dir):
    return profile.top_groups_by_count(load_flights(spark, sf_dir), "origin_country")


def q_calendar(spark, sf_dir):
    return cal.calendar_for(load_flights(spark, sf_dir), "flight_time")


def q_date_join(spark, sf_dir):
    flights = load_flights(spark, sf_dir)
    joined = cal.join_calendar(flights, cal.calendar_for(flights, "flight_time"), "flight_time")
    return joined.select("event_id", "flight_time", "date", "year", "quarter", "month", "day")


def q_date_rollup(spark, sf_dir):
    flights = load_flights(spark, sf_dir)
    return cal.rollup_by_date(flights, cal.calendar_for(flights, "flight_time"), "flight_time")


def q_aircraft_count(spark, sf_dir):
    return marts.aircraft_count(load_flights(spark, sf_dir))


def q_as_of(spark, sf_dir):
    return marts.as_of(load_flights(spark, sf_dir), "flight_time")


def q_max_alt_top10(spark, sf_dir):
    return marts.max_altitude_top_countries(load_flights(spark, sf_dir))


def q_top_speeders(spark, sf_dir):
    return marts.top_speeders(load_flights(spark, sf_dir))


def q_avg_alt_country(spark, sf_dir):
    return marts.avg_altitude_by_country(_two_runs(spark, sf_dir)).select("origin_country", r6("avg_of_avg_altitude"))


def q_flights_by_country(spark, sf_dir):
    return marts.flights_by_country(_two_runs(spark, sf_dir))


def q_map_points(spark, sf_dir):
    return marts.map_points(load_flights(spark, sf_dir)).select("longitude", "latitude", r6("velocity_sum"))


def q_country_enriched(spark, sf_dir):
    flights = load_flights(spark, sf_dir)
    out = marts.enrich_with_country(flights, _two_runs(spark, sf_dir))
    return out.select("event_id", "origin_country", "country_flight_count", r6("country_avg_speed_ms"),
                      "country_count_climbing")


def q_country_filter(spark, sf_dir):
    return marts.filter_countries(load_flights(spark, sf_dir), SLICER_COUNTRIES).select(
        "event_id", "icao24", "origin_country"
    )


def q_country_slicer(spark, sf_dir):
    return marts.slicer_values(load_flights(spark, sf_dir))


def q_default_measures_all(spark, sf_dir):
    """All nine flagged columns, summed over bronze (squawks are text, some no numbers)."""
    df = marts.default_measures(bronze_from_snapshots(states_from_flights(load_flights(spark, sf_dir))))
    return df.select(*[r6(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in df.columns])


def q_default_measures(spark, sf_dir):
    """D18 over the three flagged columns that the flights have."""
    df = marts.default_measures(load_flights(spark, sf_dir), flagged=["time_position", "baro_altitude", "velocity"])
    return df.select(*[r6(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in df.columns])


def q_props_json(spark, sf_dir):
    (events,) = load_tables(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


def q_file_lineage(spark, sf_dir):
    events = read_layer(spark, sf_dir, glob="events.parquet")
    return with_source_file(events).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


def q_append_unique(spark, sf_dir):
    """The second batch holds the stored keys again and later ones."""
    flights = load_flights(spark, sf_dir)
    keys = ["icao24", "time_position"]
    first = keep_first(flights.filter(F.col("time_position") < F.lit(LANDING_CUT)), keys, ["event_id"])
    second = append_unique(first, flights, keys, ["event_id"])
    return first.unionByName(second)


def q_incremental_silver(spark, sf_dir):
    """J1/J2, bounded: events landed in two files and deduplicated on (user, event time), a trigger after each. The
    second file repeats the half hour before the cut, which lies within the watermark delay, and holds all later events."""
    (events,) = load_tables(spark, sf_dir, "events")
    landing = scratch_path(spark, "events-landing")
    sink = scratch_path(spark, "incremental-sink")
    ckpt = scratch_path(spark, "incremental-ckpt")
    seconds = F.unix_timestamp("ts")
    for part in (seconds < LANDING_CUT, seconds >= LANDING_CUT - 1800):
        events.filter(part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        timed = stream.withColumn("event_time", F.col("ts").cast("timestamp"))
        deduped = dedupe_stream(timed, ["user_id", "event_time"], "event_time", "1 hour")
        run_available_now(deduped.select("user_id", "ts", "event_time"), sink, ckpt)
    return read_layer(spark, sink).select("user_id", "ts")


def q_incremental_silver_exact(spark, sf_dir):
    """J1 + C6: two landings (the second repeats the first and holds the rest), each micro-batch appended by key."""
    landing = scratch_path(spark, "landing-stream")
    sink, ckpt = scratch_path(spark, "silver-exact"), scratch_path(spark, "silver-exact-ckpt")
    states = states_from_flights(load_flights(spark, sf_dir))
    states.filter(F.col("time") < F.lit(LANDING_CUT)).write.mode("append").json(landing)
    run_exact_available_now(silver_rows_stream(spark, landing, stamp()), sink, ckpt)
    states.write.mode("append").json(landing)
    run_exact_available_now(silver_rows_stream(spark, landing, stamp()), sink, ckpt)
    return read_silver(spark, sink)


def q_incremental_silver_json(spark, sf_dir):
    """J1/J2 in the pipeline: three landings, the last one the earliest events (days late, new keys), taken by the
    incremental run, a batch run and the incremental run again on one lake. Every row must be stored once."""
    landing, lake = scratch_path(spark, "landing-mixed"), scratch_path(spark, "lake-mixed")
    states = states_from_flights(load_flights(spark, sf_dir))
    late = F.col("time") < F.lit(LANDING_CUT)
    steps = ((~late & (F.col("time") % 2 == 0), run_incremental), (~late, run_pipeline), (late, run_incremental))
    for part, job in steps:
        states.filter(part).write.mode("append").json(landing)
        job(spark, landing, lake, ts=datetime(2024, 2, 1))
    return read_silver(spark, silver_folder(lake)).withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


def q_states_explode_outer(spark, sf_dir):
    """Documents whose state list is NULL (here: the rows without a callsign) keep one row."""
    docs = states_from_flights(load_flights(spark, sf_dir))
    first_callsign = F.get(F.get(F.col("states"), F.lit(0)), F.lit(1))
    docs = docs.withColumn("states", F.when(first_callsign.isNull(), F.lit(None)).otherwise(F.col("states")))
    return bronze_from_snapshots(docs, keep_empty=True)


def q_describe_long(spark, sf_dir):
    df = profile.describe_long(load_flights(spark, sf_dir), ["baro_altitude", "velocity"])
    return df.select("summary", r6("baro_altitude"), r6("velocity"))


def q_preview(spark, sf_dir):
    """G1: the first five rows in a fixed order (the limit is the feature)."""
    rows = load_flights(spark, sf_dir).select("event_id", "icao24", "callsign", "origin_country", "baro_altitude")
    return profile.preview(rows, ["event_id"], 5)


def q_month_axis(spark, sf_dir):
    return cal.month_axis(cal.calendar_for(load_flights(spark, sf_dir), "flight_time"))


def q_quarter_axis(spark, sf_dir):
    return cal.quarter_axis(cal.calendar_for(load_flights(spark, sf_dir), "flight_time"))


def q_gold_folders(spark, sf_dir):
    """Two tables of the gold job's own output (one partitioned by run, one not) read as one frame, each row
    tagged with its table."""
    paths = _gold_twice(spark, sf_dir)
    both = read_tables(spark, {name: paths[name] for name in ("country_stats", "daily_summary")})
    return both.select("source_table", "origin_country", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
                       "flight_count", r6("avg_speed_ms"), "count_climbing", r6("avg_altitude_m"), "total_global_flights")


def q_report_silver(spark, sf_dir):
    """The older silver layout (17 bronze columns, ``long``/``lat``, flight time and stamp)
    written as parquet, read back through the report's declared types and renamed to current names."""
    f = load_flights(spark, sf_dir)
    null = F.lit(None).cast("string")
    legacy = f.select(
        "icao24", "callsign", "origin_country", "time_position", F.col("time_position").alias("last_contact"),
        F.col("longitude").alias("long"), F.col("latitude").alias("lat"), "baro_altitude",
        (F.col("baro_altitude") < 100).alias("on_ground"), "velocity", null.cast("double").alias("true_track"),
        null.cast("double").alias("vertical_rate"), null.alias("sensors"), F.col("baro_altitude").alias("geo_altitude"),
        null.alias("squawk"), null.cast("boolean").alias("spi"), null.cast("bigint").alias("position_source"),
        "flight_time", stamp().alias("processed_at"),
    )
    path = scratch_path(spark, "silver-legacy")
    write_overwrite(legacy, path)
    return report_silver(read_layer(spark, path))


def _lake(spark, sf_dir) -> lake.Lake:
    """Three hours of the versioned job, the last one the earliest landings (late rows of every aircraft), each landing
    holding the ones before it; silver and gold packed after the second, replaced folders deleted at the end."""
    landing, folder = scratch_path(spark, "landing-lake"), scratch_path(spark, "lake-versions")
    states = states_from_flights(load_flights(spark, sf_dir))
    late = F.col("time") < F.lit(LANDING_CUT)
    for hour, part in enumerate((~late & (F.col("time") % 2 == 0), ~late, late)):
        states.filter(part).write.mode("append").json(landing)
        made = lake.run_hour(spark, landing, folder, datetime(2024, 2, 1))
        if hour == 1:
            lake.compact_silver(spark, made, datetime(2024, 2, 1))
            lake.compact_gold(spark, made, datetime(2024, 2, 1))
    for base in (made.silver, made.gold):
        versions.expire(spark, base)
    return made


def q_lake_flight_analytics(spark, sf_dir):
    """E1/L2 carried from run to run: the phases after three runs equal those of one run over all rows."""
    rows = lake.read_gold(spark, _lake(spark, sf_dir), lake.PHASES).drop("flight_date")
    rows = rows.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))
    return rows.withColumns({c: F.round(F.col(c), 6) for c in ("longitude", "latitude", "velocity")})


def q_lake_country_stats(spark, sf_dir):
    """L4/D1/D3 merged from partial states: the statistics of the third run equal those over all rows."""
    rows = lake.latest_run(spark, _lake(spark, sf_dir), lake.COUNTRIES)
    return rows.select("origin_country", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"), "flight_count",
                       r6("avg_speed_ms"), "count_climbing", r6("avg_altitude_m"))


def q_lake_aircraft(spark, sf_dir):
    """D11 per month from the sketches of its days, beside the exact count: within four standard errors or not."""
    made = _lake(spark, sf_dir)
    month = F.date_format("flight_date", "yyyy-MM").alias("month")
    sketched = stats.aircraft_estimate(lake.read_gold(spark, made, lake.PARTIALS).withColumn("month", month), ["month"])
    exact = lake.read_silver_rows(spark, made).groupBy(month).agg(F.count_distinct("icao24").alias("aircraft_exact"))
    close = F.abs(F.col("aircraft") - F.col("aircraft_exact")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 64 * F.col("aircraft_exact"))
    return exact.join(sketched, "month").select("month", "aircraft_exact", close.alias("estimate_close"))


def _clustered_flights(spark, sf_dir) -> DataFrame:
    """The flights written in Morton order, read back."""
    path = scratch_path(spark, "flights-clustered")
    write_overwrite(spatial.clustered(load_flights(spark, sf_dir), 16), path)
    return read_layer(spark, path)


def q_clustered_box(spark, sf_dir):
    """B11 over the clustered table: files and row groups outside the box are passed over."""
    return profile.bounding_box(_clustered_flights(spark, sf_dir)).select("event_id", "latitude", "longitude")


def q_clustered_geofence(spark, sf_dir):
    """C2b over the clustered table: the scan is limited to the airports' boxes."""
    flights = _clustered_flights(spark, sf_dir).withColumn("processed_at", stamp())
    out = spatial.proximity_pruned(flights, airports_frame(spark), radius=1.0)
    return out.select("icao24", "callsign", "airport_name", r6("dist"), "proximity_status", "flight_time", "processed_at")


def q_calendar_week(spark, sf_dir):
    """C4 through the partition column: the stored silver of every month's first week (dynamic partition pruning)."""
    flights = load_flights(spark, sf_dir)
    path = scratch_path(spark, "silver-by-day")
    append_silver(to_silver(states_from_flights(flights), stamp()), path)
    days = materialize(cal.calendar_for(flights, "flight_time"), "calendar").where("day <= 7")
    joined = cal.flights_of_days(read_layer(spark, path), days)
    return joined.select("icao24", "time_position", "date", "year", "quarter", "month", "day")


def q_rescued_cells(spark, sf_dir):
    """Altitudes and speeds that are no numbers, kept beside silver; written and committed with it."""
    landing, folder = scratch_path(spark, "landing-rescue"), lake.Lake.at(scratch_path(spark, "lake-rescue"))
    bad = F.col("time") % 13 == 0
    cells = F.transform(F.col("states")[0], lambda c, i: F.when(bad & i.isin(7, 9), F.concat(F.lit("n/a "), c)).otherwise(c))
    states_from_flights(load_flights(spark, sf_dir)).withColumn("states", F.array(cells)).write.mode("overwrite").json(landing)
    made = lake.run_hour(spark, landing, folder.silver.removesuffix("/silver"), datetime(2024, 2, 1))
    return versions.read_table(spark, made.silver, lake.RESCUES).select(
        "icao24", "time_position", "column_name", F.substring("raw_text", 1, 3).alias("mark"),
        F.round(F.substring("raw_text", 5, 40).try_cast("double"), 6).alias("number")).distinct()


def q_sensors_variant(spark, sf_dir):
    """The ``sensors`` position landed as an array, a number, text or NULL, read back typed."""
    landing = scratch_path(spark, "landing-sensors")
    flights = load_flights(spark, sf_dir)
    eid = F.col("event_id")
    sensors = (F.when(eid % 4 == 0, F.concat(F.lit("["), eid.cast("string"), F.lit(","), (eid % 7).cast("string"), F.lit("]")))
               .when(eid % 4 == 1, eid.cast("string")).when(eid % 4 == 2, F.lit("broken [")))
    cells = F.array(*[F.col("icao24") if i == 0 else sensors if i == 12 else eid.cast("string") if i == 14 else F.lit(None).cast("string")
                      for i in range(17)])
    flights.select(F.col("time_position").alias("time"), F.array(cells).alias("states")).write.mode("overwrite").json(landing)
    typed = sensor_values(bronze_from_snapshots(read_snapshots(spark, landing)))
    return typed.select("icao24", F.col("squawk").alias("event"), "sensors", "sensors_type", F.array_join(
        F.col("sensor_ids").cast("array<string>"), ",").alias("sensor_ids"))


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Pin the session zone to UTC before the plan is built: epoch <-> text conversions (silver's
    flight time) resolve their zone at analysis, and the oracles are written for UTC."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flight_phase": q_flight_phase,
    "flight_phase_split": q_flight_phase_split,
    "country_stats": q_country_stats,
    "daily_summary": q_daily_summary,
    "geofence": q_geofence,
    "geofence_wide": q_geofence_wide,
    "silver_clean": q_silver_clean,
    "silver_from_json": q_silver_from_json,
    "states_explode": q_states_explode,
    "bronze_layer": q_bronze_layer,
    "pipeline_country_stats": q_pipeline_country_stats,
    "dedupe": q_dedupe,
    "null_profile": q_null_profile,
    "describe_stats": q_describe_stats,
    "dup_count": q_dup_count,
    "high_flyers": q_high_flyers,
    "europe_box": q_europe_box,
    "top_countries": q_top_countries,
    "calendar": q_calendar,
    "date_join": q_date_join,
    "date_rollup": q_date_rollup,
    "aircraft_count": q_aircraft_count,
    "as_of": q_as_of,
    "max_alt_top10": q_max_alt_top10,
    "top_speeders": q_top_speeders,
    "avg_alt_country": q_avg_alt_country,
    "flights_by_country": q_flights_by_country,
    "map_points": q_map_points,
    "country_enriched": q_country_enriched,
    "country_filter": q_country_filter,
    "country_slicer": q_country_slicer,
    "default_measures": q_default_measures,
    "props_json": q_props_json,
    "file_lineage": q_file_lineage,
    "append_unique": q_append_unique,
    "incremental_silver": q_incremental_silver,
    "incremental_silver_json": q_incremental_silver_json,
    "states_explode_outer": q_states_explode_outer,
    "describe_long": q_describe_long,
    "preview": q_preview,
    "month_axis": q_month_axis,
    "quarter_axis": q_quarter_axis,
    "gold_folders": q_gold_folders,
    "gold_flight_analytics": q_gold_flight_analytics,
    "gold_airport_distance": q_gold_airport_distance,
    "gold_daily_summary": q_gold_daily_summary,
    "describe_bronze": q_describe_bronze,
    "default_measures_all": q_default_measures_all,
    "report_silver": q_report_silver,
    "silver_strict": q_silver_strict,
    "high_flyer_count": q_high_flyer_count,
    "incremental_silver_exact": q_incremental_silver_exact,
    "lake_flight_analytics": q_lake_flight_analytics,
    "lake_country_stats": q_lake_country_stats,
    "lake_aircraft": q_lake_aircraft,
    "clustered_box": q_clustered_box,
    "clustered_geofence": q_clustered_geofence,
    "calendar_week": q_calendar_week,
    "rescued_cells": q_rescued_cells,
    "sensors_variant": q_sensors_variant,
}

QUERIES = {name: _in_utc(fn) for name, fn in _QUERIES.items()}
