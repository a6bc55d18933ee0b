"""Fixed values the results depend on. They must stay equal to the source pipeline's values."""

from __future__ import annotations

# --- fixed values: state-vector array positions (0-based), in position order -------------------
STATE_FIELDS = [
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("long", "double"),
    ("lat", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "string"),
    ("geo_altitude", "double"),
    ("squawk", "string"),
    ("spi", "boolean"),
    ("position_source", "bigint"),
]

# --- fixed values: positions the silver job keeps, and their output names ----------------------
# Position 4 is kept under the name time_position (it is really last_contact); see README.
SILVER_POSITIONS = [
    (0, "icao24"),
    (1, "callsign"),
    (2, "origin_country"),
    (4, "time_position"),
    (5, "longitude"),
    (6, "latitude"),
    (7, "baro_altitude"),
    (9, "velocity"),
    (10, "true_track"),
    (11, "vertical_rate"),
]
SILVER_DOUBLE_COLUMNS = ["latitude", "longitude", "baro_altitude", "velocity", "true_track", "vertical_rate"]

# --- fixed values: reference airports (code, latitude, longitude, name) ------------------------
AIRPORTS = [
    ("LHR", 51.4700, -0.4543, "London Heathrow"),
    ("JFK", 40.6413, -73.7781, "New York JFK"),
    ("DXB", 25.2532, 55.3657, "Dubai International"),
    ("SIN", 1.3644, 103.9915, "Singapore Changi"),
]

# --- fixed values: inline city table of the report (latitude, longitude, city) -----------------
INLINE_CITIES = [
    (51.5, -0.1, "London"),
    (40.7, -74.0, "NYC"),
]

# --- fixed values: thresholds and labels --------------------------------------------------------
PHASE_DELTA = 15.0                 # metres of altitude change that count as climbing / descending
GEOFENCE_RADIUS = 0.2              # planar degrees
LOW_ALTITUDE = 3000.0              # below this near an airport: landing / taking off
HIGH_FLYER_ALTITUDE = 10000.0
EUROPE_LAT = (35.0, 70.0)
EUROPE_LON = (-25.0, 45.0)
TOP_N = 10

PHASE_INITIALIZING = "Initializing"
PHASE_CLIMBING = "Climbing"
PHASE_DESCENDING = "Descending"
PHASE_CRUISING = "Cruising"
STATUS_LOW = "Landing/Taking Off"
STATUS_PASSING = "Passing Over"
QUARTER_PREFIX = "Qtr "

# --- fixed values: columns the report model sums by default (its older silver schema) --------------
DEFAULT_SUM_COLUMNS = [
    "time_position", "last_contact", "baro_altitude", "velocity", "true_track",
    "vertical_rate", "geo_altitude", "squawk", "position_source",
]

# --- fixed values: the report's older silver schema names -> current names --------------------------
LEGACY_RENAMES = {"long": "longitude", "lat": "latitude"}

# --- fixed values: the report's declared column types for its (older) silver table, in order ----
# "any" is kept as text; "datetime" (no zone) is TIMESTAMP_NTZ.
REPORT_CLEANED_TYPES = [
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("long", "double"),
    ("lat", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "string"),
    ("geo_altitude", "double"),
    ("squawk", "bigint"),
    ("spi", "boolean"),
    ("position_source", "bigint"),
    ("flight_time", "timestamp_ntz"),
    ("processed_at", "timestamp_ntz"),
]

# Years a calendar may span; times beyond them are taken for wrong ones.
CALENDAR_YEARS = (1900, 2199)
