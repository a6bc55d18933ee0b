"""Flights derived from the driver's tables (events, customer, nation).

The test lake holds no aircraft data, so a view derives state rows from ``events``: one event is one
state vector of aircraft ``'a' || user_id`` whose country is the user's nation. The same definition
exists as SQL in ``plans.oracles`` so both engines see identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flightlake.fixed import AIRPORTS

FLIGHT_COLUMNS = [
    "event_id", "icao24", "callsign", "origin_country", "time_position", "flight_time",
    "baro_altitude", "velocity", "latitude", "longitude",
]


# Fixed schemas of the driver tables the stand-in reads (no footer-inference job per read).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    out = []
    for n in names:
        reader = spark.read.schema(TABLE_SCHEMAS[n]) if n in TABLE_SCHEMAS else spark.read
        out.append(reader.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet"))
    return out


def flights_from_tables(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """The stand-in ``flights`` rows (see FIXTURES.md section 4 for the column rules).

    ``events`` joins ``customer`` on the user key first: Catalyst broadcasts the customer side when
    its file-size estimate is under the broadcast threshold and shuffle-joins it beyond (AQE then
    splits a user holding a large share of the events). The fixed 25-row ``nation`` dimension is
    joined last, on the narrow result.
    """
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    cust = customer.select("c_custkey", "c_nationkey")
    nat = nation.select("n_nationkey", F.col("n_name").alias("origin_country"))
    joined = ev.join(cust, ev.user_id == cust.c_custkey, "left").join(
        nat, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    eid = F.col("event_id")
    callsign = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(F.col("event_type") == "signup", F.lit(" " * 8))
        .otherwise(F.concat(F.lit("  "), F.upper("event_type"), F.col("user_id").cast("string"), F.lit(" ")))
    )
    # Half of the rows lie around the four airports, the others anywhere; every fifth row has its time cut to the
    # hour, so some aircraft repeat a (key, time) with different values.
    near = eid % 8
    lat0, lon0 = (
        F.coalesce(*[F.when(near == i, F.lit(port[at])) for i, port in enumerate(AIRPORTS)]) for at in (1, 2)
    )
    lat = F.when(near < 4, lat0 + ((eid * 37) % 101 - 50).cast("double") / F.lit(100.0)).otherwise(
        F.lit(-70.0) + ((eid * 37) % 1400).cast("double") / F.lit(10.0))
    lon = F.when(near < 4, lon0 + ((eid * 53) % 97 - 48).cast("double") / F.lit(100.0) + F.lit(0.0037)).otherwise(
        F.lit(-179.0) + ((eid * 53) % 3580).cast("double") / F.lit(10.0))
    time = F.when(eid % 5 == 0, F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")).otherwise(F.col("ts"))
    return joined.select(
        eid.alias("event_id"),
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("icao24"),
        callsign.alias("callsign"),
        F.col("origin_country"),
        F.unix_timestamp(time).alias("time_position"),
        time.alias("flight_time"),
        F.when(eid % 40 == 0, F.lit(None).cast("double")).otherwise(F.col("value") * 30).alias("baro_altitude"),
        (F.lit(100) + F.col("value") / 3).alias("velocity"),
        F.when(eid % 50 == 0, F.lit(None).cast("double")).otherwise(lat).alias("latitude"),
        F.when(eid % 70 == 0, F.lit(None).cast("double")).otherwise(lon).alias("longitude"),
    )


def load_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customer, nation = load_tables(spark, sf_dir, "events", "customer", "nation")
    return flights_from_tables(events, customer, nation)


def states_from_flights(flights: DataFrame) -> DataFrame:
    """Snapshot documents ``(time, states)`` built from flight rows, one state array per row.

    Values become text as in landed JSON. Position 4 carries the epoch seconds and 3 is up to 29 seconds before;
    position 8 (on ground) is ``altitude < 100``, 13 (geometric altitude) repeats the barometric one; 10, 11 and
    14 to 16 follow from the event id (some squawks are no numbers); 12 is NULL.
    """
    def txt(c):
        return F.col(c).cast("string")

    eid = F.col("event_id")
    track, rate = (eid * 7) % 360, (eid % 41 - 20) / F.lit(2.0)
    squawk = F.when(eid % 9 == 0, F.lit("7A0")).otherwise(F.lpad((eid % 7777).cast("string"), 4, "0"))
    state = F.array(
        txt("icao24"), txt("callsign"), txt("origin_country"), (F.col("time_position") - eid % 30).cast("string"),
        txt("time_position"), txt("longitude"), txt("latitude"), txt("baro_altitude"),
        (F.col("baro_altitude") < 100).cast("string"), txt("velocity"), track.cast("string"), rate.cast("string"),
        F.lit(None).cast("string"), txt("baro_altitude"), squawk, (eid % 11 == 0).cast("string"),
        (eid % 4).cast("string"),
    )
    return flights.select(F.col("time_position").alias("time"), F.array(state).alias("states"))
