"""Fixed schemas for every layer (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

# Landed snapshot document: {"time": 1700000000, "states": [[...17 values...], ...]}
RAW_SNAPSHOT = T.StructType([
    T.StructField("time", T.LongType(), True),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType(), True), True), True),
])

SILVER = T.StructType([
    T.StructField("icao24", T.StringType(), True),
    T.StructField("callsign", T.StringType(), True),
    T.StructField("origin_country", T.StringType(), True),
    T.StructField("time_position", T.StringType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("baro_altitude", T.DoubleType(), True),
    T.StructField("velocity", T.DoubleType(), True),
    T.StructField("true_track", T.DoubleType(), True),
    T.StructField("vertical_rate", T.DoubleType(), True),
    T.StructField("flight_time", T.StringType(), True),
    T.StructField("processed_at", T.TimestampType(), True),
])

AIRPORTS = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("lat_ref", T.DoubleType(), True),
    T.StructField("lon_ref", T.DoubleType(), True),
    T.StructField("airport_name", T.StringType(), True),
])

CITIES = T.StructType([
    T.StructField("Lat", T.DoubleType(), True),
    T.StructField("Lon", T.DoubleType(), True),
    T.StructField("City", T.StringType(), True),
])
