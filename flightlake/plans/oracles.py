"""DuckDB SQL for every registered query (same names, same column aliases).

Views ``events``, ``customer``, ``nation`` (and the other driver tables) are registered by the caller.
Decimal literals are cast to DOUBLE (DuckDB and Spark read ``51.47`` as DECIMAL), NULL ordering is
spelled out (DuckDB sorts NULLs last, Spark first), and computed doubles are rounded to 6 decimals.
"""

from __future__ import annotations

from flightlake.plans.registry import LANDING_CUT, RUN_TS

STAMP = f"TIMESTAMP '{RUN_TS}'"

FLIGHTS = """flights AS (
  SELECT e.event_id,
         'a' || CAST(e.user_id AS VARCHAR) AS icao24,
         CASE WHEN e.event_type = 'error' THEN NULL
              WHEN e.event_type = 'signup' THEN '        '
              ELSE '  ' || upper(e.event_type) || CAST(e.user_id AS VARCHAR) || ' ' END AS callsign,
         n.n_name AS origin_country,
         CAST(floor(epoch(CASE WHEN e.event_id % 5 = 0 THEN date_trunc('hour', e.ts) ELSE e.ts END)) AS BIGINT)
           AS time_position,
         CASE WHEN e.event_id % 5 = 0 THEN date_trunc('hour', e.ts) ELSE e.ts END AS flight_time,
         CASE WHEN e.event_id % 40 = 0 THEN NULL ELSE e.value * 30 END AS baro_altitude,
         100 + e.value / 3 AS velocity,
         CASE WHEN e.event_id % 50 = 0 THEN NULL
              WHEN e.event_id % 8 < 4
              THEN CAST(CASE e.event_id % 8 WHEN 0 THEN 51.4700 WHEN 1 THEN 40.6413 WHEN 2 THEN 25.2532 ELSE 1.3644 END
                   AS DOUBLE) + CAST((e.event_id * 37) % 101 - 50 AS DOUBLE) / CAST(100 AS DOUBLE)
              ELSE CAST(-70 AS DOUBLE) + CAST((e.event_id * 37) % 1400 AS DOUBLE) / CAST(10 AS DOUBLE) END AS latitude,
         CASE WHEN e.event_id % 70 = 0 THEN NULL
              WHEN e.event_id % 8 < 4
              THEN CAST(CASE e.event_id % 8 WHEN 0 THEN -0.4543 WHEN 1 THEN -73.7781 WHEN 2 THEN 55.3657 ELSE 103.9915 END
                   AS DOUBLE) + CAST((e.event_id * 53) % 97 - 48 AS DOUBLE) / CAST(100 AS DOUBLE) + CAST(0.0037 AS DOUBLE)
              ELSE CAST(-179 AS DOUBLE) + CAST((e.event_id * 53) % 3580 AS DOUBLE) / CAST(10 AS DOUBLE) END AS longitude
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

# Positions 10 and 11 of the stand-in's state rows.
TRACK = "CAST((event_id * 7) % 360 AS DOUBLE)"
RATE = "CAST(event_id % 41 - 20 AS DOUBLE) / CAST(2 AS DOUBLE)"

PHASED = f"""lagged AS (
  SELECT *, lag(baro_altitude) OVER (
      PARTITION BY icao24 ORDER BY flight_time ASC NULLS FIRST, event_id ASC NULLS FIRST) AS prev_alt
  FROM flights
), phased AS (
  SELECT *, CASE WHEN prev_alt IS NULL THEN 'Initializing'
                 WHEN baro_altitude > prev_alt + 15 THEN 'Climbing'
                 WHEN baro_altitude < prev_alt - 15 THEN 'Descending'
                 ELSE 'Cruising' END AS flight_phase,
         {STAMP} AS processed_at
  FROM lagged
)"""

# Two runs appended to the statistics: an earlier one over the flights before the cut, then the run above.
EARLIER = "TIMESTAMP '2024-01-31 00:00:00'"
EARLIER_RUN = (PHASED.replace("lagged", "lagged0").replace("phased AS", "phased0 AS")
               .replace("FROM flights", f"FROM flights WHERE time_position < {LANDING_CUT}").replace(STAMP, EARLIER))

STATS = """stats AS (
  SELECT origin_country, processed_at,
         count(icao24) AS flight_count,
         avg(velocity) AS avg_speed_ms,
         count(*) FILTER (WHERE flight_phase = 'Climbing') AS count_climbing,
         avg(baro_altitude) AS avg_altitude_m
  FROM phased GROUP BY origin_country, processed_at
)"""

TWO_RUNS = f"""{EARLIER_RUN}, {PHASED}, {STATS.replace("FROM phased", "FROM (FROM phased UNION ALL FROM phased0)")}"""

AIRPORTS = """airports(code, lat_ref, lon_ref, airport_name) AS (
  VALUES ('LHR', CAST(51.4700 AS DOUBLE), CAST(-0.4543 AS DOUBLE), 'London Heathrow'),
         ('JFK', CAST(40.6413 AS DOUBLE), CAST(-73.7781 AS DOUBLE), 'New York JFK'),
         ('DXB', CAST(25.2532 AS DOUBLE), CAST(55.3657 AS DOUBLE), 'Dubai International'),
         ('SIN', CAST(1.3644 AS DOUBLE), CAST(103.9915 AS DOUBLE), 'Singapore Changi')
)"""

CALENDAR = """cal AS (
  SELECT CAST(d AS DATE) AS date,
         CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month_no,
         monthname(d) AS month,
         CAST(quarter(d) AS INTEGER) AS quarter_no,
         'Qtr ' || CAST(quarter(d) AS VARCHAR) AS quarter,
         CAST(day(d) AS INTEGER) AS day
  FROM (SELECT unnest(generate_series(make_date(year(min(flight_time)), 1, 1),
                                      make_date(year(max(flight_time)), 12, 31), INTERVAL 1 DAY)) AS d
        FROM flights)
)"""


def _geofence(radius: float) -> str:
    dist = "sqrt(pow(f.latitude - a.lat_ref, 2) + pow(f.longitude - a.lon_ref, 2))"
    return f"""WITH {FLIGHTS}, {AIRPORTS}
SELECT f.icao24, f.callsign, a.airport_name, round({dist}, 6) AS dist,
       CASE WHEN f.baro_altitude < 3000 THEN 'Landing/Taking Off' ELSE 'Passing Over' END AS proximity_status,
       f.flight_time, {STAMP} AS processed_at
FROM flights f CROSS JOIN airports a
WHERE {dist} < CAST({radius} AS DOUBLE)"""


def _silver_ctes(strict: bool = False) -> str:
    """CTE chain ending in ``silver``: the silver job's rows over the stand-in flights.

    ``strict`` adds the optional filters: blank callsigns and NULL coordinates removed before the
    de-duplication."""
    rest = ["callsign", "origin_country", "longitude", "latitude", "baro_altitude", "velocity", "true_track",
            "vertical_rate", "flight_time", "processed_at"]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return f"""{FLIGHTS}, s AS (
  SELECT icao24, trim(callsign) AS callsign, origin_country, CAST(time_position AS VARCHAR) AS time_position,
         longitude, latitude, baro_altitude, velocity,
         {TRACK} AS true_track, {RATE} AS vertical_rate,
         strftime(make_timestamp(time_position * 1000000), '%Y-%m-%d %H:%M:%S') AS flight_time,
         {STAMP} AS processed_at
  FROM flights WHERE callsign IS NOT NULL{
    " AND trim(callsign) <> '' AND latitude IS NOT NULL AND longitude IS NOT NULL" if strict else ""}
), r AS (
  SELECT *, row_number() OVER (PARTITION BY icao24, time_position ORDER BY {order}) AS rn FROM s
), silver AS (
  SELECT * EXCLUDE (rn) FROM r WHERE rn = 1
)"""


def _silver() -> str:
    return f"WITH {_silver_ctes()}\nSELECT * FROM silver"


def _first_per_key() -> str:
    rest = ["icao24", "callsign", "origin_country", "flight_time", "baro_altitude", "velocity", "latitude",
            "longitude"]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return f"""WITH {FLIGHTS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY icao24, time_position ORDER BY event_id ASC NULLS FIRST, {order}) AS rn
  FROM (SELECT * FROM flights UNION ALL SELECT * FROM flights)
)
SELECT * EXCLUDE (rn) FROM r WHERE rn = 1"""


def _gold_ctes() -> str:
    """Silver rows, then phase over the text flight time (``phased``), as the gold job computes them."""
    return f"""{_silver_ctes()}, lagged AS (
  SELECT *, lag(baro_altitude) OVER (PARTITION BY icao24 ORDER BY flight_time ASC NULLS FIRST,
    time_position ASC NULLS FIRST) AS prev_alt FROM silver
), phased AS (
  SELECT *, CASE WHEN prev_alt IS NULL THEN 'Initializing'
                 WHEN baro_altitude > prev_alt + 15 THEN 'Climbing'
                 WHEN baro_altitude < prev_alt - 15 THEN 'Descending'
                 ELSE 'Cruising' END AS flight_phase
  FROM lagged
)"""


def _describe_row(column: str) -> str:
    """Statistics of one bronze column: numbers as DOUBLE, text (what parses as a number) with text bounds."""
    text = column in ("icao24", "callsign", "origin_country", "sensors", "squawk")
    number = f"TRY_CAST({column} AS DOUBLE)"
    bounds = (f"CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number, min({column}) AS min_text, "
              f"max({column}) AS max_text" if text else
              f"round(min({number}), 6) AS min_number, round(max({number}), 6) AS max_number, "
              "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text")
    return (f"SELECT '{column}' AS column_name, count({column}) AS n, round(avg({number}), 3) AS mean, "
            f"round(stddev_samp({number}), 3) AS stddev, {bounds} FROM bronze")


def _pipeline_stats() -> str:
    """Country statistics over the gold job's phases."""
    return f"""WITH {_gold_ctes()}
SELECT origin_country, processed_at, count(icao24) AS flight_count, round(avg(velocity), 6) AS avg_speed_ms,
       count(*) FILTER (WHERE flight_phase = 'Climbing') AS count_climbing,
       round(avg(baro_altitude), 6) AS avg_altitude_m
FROM phased GROUP BY origin_country, processed_at"""


# The 17 state positions of a snapshot row built from the stand-in (expression, bronze name).
STATE_COLUMNS = [
    ("icao24", "icao24"), ("callsign", "callsign"), ("origin_country", "origin_country"),
    ("time_position - event_id % 30", "time_position"), ("time_position", "last_contact"), ("longitude", "long"),
    ("latitude", "lat"), ("baro_altitude", "baro_altitude"), ("baro_altitude < 100", "on_ground"),
    ("velocity", "velocity"), (TRACK, "true_track"), (RATE, "vertical_rate"),
    ("CAST(NULL AS VARCHAR)", "sensors"), ("baro_altitude", "geo_altitude"),
    ("CASE WHEN event_id % 9 = 0 THEN '7A0' ELSE lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') END", "squawk"),
    ("event_id % 11 = 0", "spi"), ("CAST(event_id % 4 AS BIGINT)", "position_source"),
]

FLIGHT_COLS = ["event_id", "icao24", "callsign", "origin_country", "time_position", "flight_time",
               "baro_altitude", "velocity", "latitude", "longitude"]

SQL: dict[str, str] = {
    "flight_phase": f"""WITH {FLIGHTS}, {PHASED}
SELECT event_id, icao24, flight_time, baro_altitude, prev_alt, flight_phase FROM phased""",

    "country_stats": f"""WITH {FLIGHTS}, {PHASED}, {STATS}
SELECT origin_country, processed_at, flight_count, round(avg_speed_ms, 6) AS avg_speed_ms, count_climbing,
       round(avg_altitude_m, 6) AS avg_altitude_m
FROM stats""",

    "daily_summary": f"""WITH {FLIGHTS}
SELECT {STAMP} AS processed_at, count(*) AS total_global_flights FROM flights""",

    "geofence": _geofence(0.2),
    "geofence_wide": _geofence(1.0),
    "silver_clean": _silver(),
    "silver_from_json": _silver(),
    "incremental_silver_exact": _silver(),
    "incremental_silver_json": _silver(),
    "silver_strict": f"WITH {_silver_ctes(strict=True)}\nSELECT * FROM silver",

    "high_flyer_count": f"""WITH {FLIGHTS}
SELECT count(*) AS row_count FROM flights WHERE baro_altitude > 10000""",

    "states_explode": f"""WITH {FLIGHTS}
SELECT time_position AS snapshot_time, {", ".join(f"{e} AS {a}" for e, a in STATE_COLUMNS)}
FROM flights""",

    "states_explode_outer": f"""WITH {FLIGHTS}
SELECT time_position AS snapshot_time,
       {", ".join(f"CASE WHEN callsign IS NULL THEN NULL ELSE {e} END AS {a}" for e, a in STATE_COLUMNS)}
FROM flights""",

    "describe_long": f"""WITH {FLIGHTS}, s AS (
  SELECT {", ".join(f"count({c}) AS {c}_count, avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_stddev, "
                    f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ["baro_altitude", "velocity"])}
  FROM flights
)
{" UNION ALL ".join(
        f"SELECT '{st}' AS summary, round(CAST(baro_altitude_{st} AS DOUBLE), 6) AS baro_altitude, "
        f"round(CAST(velocity_{st} AS DOUBLE), 6) AS velocity FROM s"
        for st in ["count", "mean", "stddev", "min", "max"])}""",

    "preview": f"""WITH {FLIGHTS}
SELECT event_id, icao24, callsign, origin_country, baro_altitude FROM flights ORDER BY event_id LIMIT 5""",

    "month_axis": f"""WITH {FLIGHTS}, {CALENDAR}
SELECT DISTINCT month_no, month FROM cal ORDER BY month_no""",

    "quarter_axis": f"""WITH {FLIGHTS}, {CALENDAR}
SELECT DISTINCT quarter_no, quarter FROM cal ORDER BY quarter_no""",

    "gold_folders": f"""WITH {_gold_ctes()}
SELECT 'country_stats' AS source_table, origin_country, processed_at, count(icao24) AS flight_count,
       round(avg(velocity), 6) AS avg_speed_ms, count(*) FILTER (WHERE flight_phase = 'Climbing') AS count_climbing,
       round(avg(baro_altitude), 6) AS avg_altitude_m, CAST(NULL AS BIGINT) AS total_global_flights
FROM phased GROUP BY origin_country, processed_at
UNION ALL
SELECT 'daily_summary', NULL, {STAMP}, NULL, NULL, NULL, NULL, count(*) FROM silver""",

    "gold_flight_analytics": f"""WITH {_gold_ctes()}
SELECT icao24, callsign, origin_country, time_position, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude,
       baro_altitude, round(velocity, 6) AS velocity, true_track, vertical_rate, flight_time, processed_at, prev_alt,
       flight_phase
FROM phased""",

    "gold_airport_distance": f"""WITH {_gold_ctes()}, {AIRPORTS}
SELECT f.icao24, f.callsign, a.airport_name,
       round(sqrt(pow(f.latitude - a.lat_ref, 2) + pow(f.longitude - a.lon_ref, 2)), 6) AS dist,
       CASE WHEN f.baro_altitude < 3000 THEN 'Landing/Taking Off' ELSE 'Passing Over' END AS proximity_status,
       f.flight_time, f.processed_at
FROM silver f CROSS JOIN airports a
WHERE sqrt(pow(f.latitude - a.lat_ref, 2) + pow(f.longitude - a.lon_ref, 2)) < CAST(0.2 AS DOUBLE)""",

    "gold_daily_summary": f"""WITH {_silver_ctes()}
SELECT {STAMP} AS processed_at, count(*) AS total_global_flights FROM silver""",

    "describe_bronze": f"""WITH {FLIGHTS}, bronze AS (SELECT {", ".join(f"{e} AS {a}" for e, a in STATE_COLUMNS)} FROM flights)
{" UNION ALL ".join(_describe_row(a) for _, a in STATE_COLUMNS if a not in ("on_ground", "spi"))}""",

    "default_measures_all": f"""WITH {FLIGHTS}, bronze AS (SELECT {", ".join(f"{e} AS {a}" for e, a in STATE_COLUMNS)} FROM flights)
SELECT origin_country, CAST(sum(time_position) AS BIGINT) AS sum_time_position,
       CAST(sum(last_contact) AS BIGINT) AS sum_last_contact, round(sum(baro_altitude), 6) AS sum_baro_altitude,
       round(sum(velocity), 6) AS sum_velocity, round(sum(true_track), 6) AS sum_true_track,
       round(sum(vertical_rate), 6) AS sum_vertical_rate, round(sum(geo_altitude), 6) AS sum_geo_altitude,
       CAST(sum(TRY_CAST(squawk AS BIGINT)) AS BIGINT) AS sum_squawk,
       CAST(sum(position_source) AS BIGINT) AS sum_position_source
FROM bronze GROUP BY origin_country""",

    "report_silver": f"""WITH {FLIGHTS}
SELECT icao24, callsign, origin_country, time_position, time_position AS last_contact, longitude, latitude,
       baro_altitude, baro_altitude < 100 AS on_ground, velocity, CAST(NULL AS DOUBLE) AS true_track,
       CAST(NULL AS DOUBLE) AS vertical_rate, CAST(NULL AS VARCHAR) AS sensors, baro_altitude AS geo_altitude,
       CAST(NULL AS BIGINT) AS squawk, CAST(NULL AS BOOLEAN) AS spi, CAST(NULL AS BIGINT) AS position_source,
       flight_time, {STAMP} AS processed_at
FROM flights""",

    "pipeline_country_stats": _pipeline_stats(),

    "dedupe": _first_per_key(),

    "null_profile": f"""WITH {FLIGHTS}
SELECT {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in FLIGHT_COLS)} FROM flights""",

    "describe_stats": f"""WITH {FLIGHTS}
SELECT {", ".join(
        f"count({c}) AS {c}_count, round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_stddev, "
        f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ["baro_altitude", "velocity"])}
FROM flights""",

    "dup_count": f"""WITH {FLIGHTS}, k AS (SELECT icao24, time_position, count(*) AS n FROM flights GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM k""",

    "high_flyers": f"""WITH {FLIGHTS}
SELECT event_id, icao24, callsign, origin_country, baro_altitude FROM flights WHERE baro_altitude > 10000""",

    "europe_box": f"""WITH {FLIGHTS}
SELECT event_id, latitude, longitude FROM flights
WHERE latitude BETWEEN 35 AND 70 AND longitude BETWEEN -25 AND 45""",

    "top_countries": f"""WITH {FLIGHTS}
SELECT origin_country, count(*) AS count FROM flights GROUP BY origin_country
ORDER BY count DESC, origin_country ASC NULLS FIRST LIMIT 10""",

    "calendar": f"""WITH {FLIGHTS}, {CALENDAR}
SELECT * FROM cal""",

    "date_join": f"""WITH {FLIGHTS}, {CALENDAR}
SELECT f.event_id, f.flight_time, c.date, c.year, c.quarter, c.month, c.day
FROM flights f LEFT JOIN cal c ON CAST(f.flight_time AS DATE) = c.date""",

    "date_rollup": f"""WITH {FLIGHTS}, {CALENDAR}
SELECT c.year, c.quarter_no, c.month_no, c.day, count(*) AS flight_rows
FROM flights f LEFT JOIN cal c ON CAST(f.flight_time AS DATE) = c.date
GROUP BY ROLLUP (c.year, c.quarter_no, c.month_no, c.day)""",

    "aircraft_count": f"""WITH {FLIGHTS}
SELECT count(DISTINCT icao24) AS aircraft FROM flights""",

    "as_of": f"""WITH {FLIGHTS}
SELECT min(flight_time) AS as_of FROM flights""",

    "max_alt_top10": f"""WITH {FLIGHTS}, g AS (
  SELECT origin_country, sum(baro_altitude) AS s, max(baro_altitude) AS max_altitude
  FROM flights WHERE origin_country IS NOT NULL GROUP BY origin_country
), r AS (SELECT *, rank() OVER (ORDER BY s DESC NULLS LAST) AS rk FROM g WHERE s IS NOT NULL)
SELECT origin_country, max_altitude FROM r WHERE rk <= 10""",

    "top_speeders": f"""WITH {FLIGHTS}, g AS (
  SELECT callsign, sum(velocity) AS s FROM flights WHERE callsign IS NOT NULL GROUP BY callsign
), t AS (SELECT callsign FROM (SELECT callsign, rank() OVER (ORDER BY s DESC NULLS LAST) AS rk
                               FROM g WHERE s IS NOT NULL) WHERE rk <= 10)
SELECT DISTINCT velocity, callsign, origin_country FROM flights WHERE callsign IN (SELECT callsign FROM t)""",

    "avg_alt_country": f"""WITH {FLIGHTS}, {TWO_RUNS}
SELECT origin_country, round(avg(avg_altitude_m), 6) AS avg_of_avg_altitude FROM stats GROUP BY origin_country""",

    "flights_by_country": f"""WITH {FLIGHTS}, {TWO_RUNS}
SELECT origin_country, CAST(sum(flight_count) AS BIGINT) AS total_flights FROM stats GROUP BY origin_country""",

    "map_points": f"""WITH {FLIGHTS}
SELECT longitude, latitude, round(coalesce(sum(velocity), 0), 6) AS velocity_sum
FROM flights GROUP BY longitude, latitude""",

    "country_enriched": f"""WITH {FLIGHTS}, {TWO_RUNS}, latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY origin_country ORDER BY processed_at DESC NULLS LAST) AS rn
                 FROM stats) WHERE rn = 1
)
SELECT f.event_id, f.origin_country, l.flight_count AS country_flight_count,
       round(l.avg_speed_ms, 6) AS country_avg_speed_ms, l.count_climbing AS country_count_climbing
FROM flights f LEFT JOIN latest l ON f.origin_country = l.origin_country""",

    "country_filter": f"""WITH {FLIGHTS}
SELECT event_id, icao24, origin_country FROM flights WHERE origin_country IN ('NATION_0', 'NATION_1')""",

    "country_slicer": f"""WITH {FLIGHTS}
SELECT DISTINCT origin_country FROM flights""",

    "default_measures": f"""WITH {FLIGHTS}
SELECT origin_country, CAST(sum(time_position) AS BIGINT) AS sum_time_position,
       round(sum(baro_altitude), 6) AS sum_baro_altitude, round(sum(velocity), 6) AS sum_velocity
FROM flights GROUP BY origin_country""",

    "props_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",

    "file_lineage": """SELECT 'events.parquet' AS source_file, count(*) AS n FROM events""",

    "append_unique": _first_per_key(),

    "incremental_silver": """SELECT DISTINCT user_id, ts FROM events""",
}

# The bronze job's stored table holds the same rows as the exploded snapshots.
SQL["bronze_layer"] = SQL["states_explode"]
# The split (hot-group) path of the lag must give the plain window's rows.
SQL["flight_phase_split"] = SQL["flight_phase"]
SQL["lake_flight_analytics"] = SQL["gold_flight_analytics"]
SQL["lake_country_stats"] = SQL["pipeline_country_stats"]
SQL["lake_aircraft"] = f"""WITH {_silver_ctes()}
SELECT strftime(make_timestamp(CAST(time_position AS BIGINT) * 1000000), '%Y-%m') AS month, count(DISTINCT icao24) AS aircraft_exact,
       true AS estimate_close
FROM silver GROUP BY 1"""
SQL["clustered_box"] = SQL["europe_box"]
SQL["clustered_geofence"] = SQL["geofence_wide"]
SQL["calendar_week"] = f"""WITH {_silver_ctes()}, {CALENDAR}
SELECT icao24, time_position, date, year, quarter, month, day
FROM silver JOIN cal ON CAST(make_timestamp(CAST(time_position AS BIGINT) * 1000000) AS DATE) = cal.date WHERE day <= 7"""
# The raw text is compared by the number that stands in it, since engines write doubles differently.
SQL["rescued_cells"] = f"""WITH {FLIGHTS}, bad AS (SELECT * FROM flights WHERE callsign IS NOT NULL AND time_position % 13 = 0),
cells AS (SELECT icao24, time_position, 'baro_altitude' AS column_name, baro_altitude AS cell FROM bad
          UNION ALL SELECT icao24, time_position, 'velocity', velocity FROM bad)
SELECT DISTINCT icao24, CAST(time_position AS VARCHAR) AS time_position, column_name, 'n/a' AS mark, round(cell, 6) AS number
FROM cells WHERE cell IS NOT NULL"""
SQL["sensors_variant"] = f"""WITH {FLIGHTS}
SELECT icao24, CAST(event_id AS VARCHAR) AS event,
       CASE event_id % 4 WHEN 0 THEN '[' || event_id || ',' || event_id % 7 || ']' WHEN 1 THEN CAST(event_id AS VARCHAR)
            WHEN 2 THEN 'broken [' END AS sensors,
       CASE event_id % 4 WHEN 0 THEN 'ARRAY<BIGINT>' WHEN 1 THEN 'BIGINT' END AS sensors_type,
       CASE event_id % 4 WHEN 0 THEN event_id || ',' || event_id % 7 WHEN 1 THEN CAST(event_id AS VARCHAR) END AS sensor_ids
FROM flights"""
