"""Airport geofencing (C1, C2, C2b): flights within a planar radius of reference airports.

The source pipeline pairs every flight with every airport and filters on distance. Here the same
rows come from an equi-join on grid cells: with cell size ``c`` = the smallest power of two not
below the radius, a point closer than the radius to an airport differs from it by less than ``c``
on each axis, hence lies in the airport's cell or one of its 8 neighbours. Each airport is expanded
to those 9 cells, flights get their one cell, and a hash equi-join on the cell replaces the
flights x airports product; the exact distance filter then runs on the few candidate pairs. A pair
meets in at most one cell, so nothing is produced twice. Division by a power of two is exact, so the
cell of a point is computed without rounding drift.

Join strategy: the airport-cell side (9 rows per airport) is broadcast when its bytes, added up while it is
written, prove it small (4 airports -> 36 rows), so flights are never shuffled by cell; an airport list
beyond the bound falls back to a shuffled equi-join, where AQE splits the hot cells around busy
airports.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from flightlake.fixed import GEOFENCE_RADIUS, LOW_ALTITUDE
from flightlake.functions.columns import planar_distance, proximity_status_expr
from flightlake.operators.joins import broadcast_if_small


def cell_size(radius: float) -> float:
    if radius <= 0:
        raise ValueError("radius must be positive")
    return 2.0 ** math.ceil(math.log2(radius))


def _cell(c, size: float):
    return F.floor(F.col(c) / F.lit(size))


def airport_proximity(
    flights: DataFrame,
    airports: DataFrame,
    radius: float = GEOFENCE_RADIUS,
    low_altitude: float = LOW_ALTITUDE,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Flights x airports pairs with ``dist < radius``, plus ``dist`` and ``proximity_status``."""
    size = cell_size(radius)
    neighbours = F.array(F.lit(-1), F.lit(0), F.lit(1))
    airport_cells = (
        airports.withColumn("_gf_dlat", F.explode(neighbours))
        .withColumn("_gf_dlon", F.explode(neighbours))
        .withColumn("_gf_clat", _cell("lat_ref", size) + F.col("_gf_dlat"))
        .withColumn("_gf_clon", _cell("lon_ref", size) + F.col("_gf_dlon"))
        .drop("_gf_dlat", "_gf_dlon")
    )
    airport_cells, _ = broadcast_if_small(airport_cells, name="airport-cells")
    flight_cells = flights.withColumn("_gf_clat", _cell(lat, size)).withColumn("_gf_clon", _cell(lon, size))
    pairs = flight_cells.join(airport_cells, ["_gf_clat", "_gf_clon"], "inner")
    return (
        pairs.withColumn("dist", planar_distance(lat, lon, "lat_ref", "lon_ref"))
        .filter(F.col("dist") < F.lit(radius))
        .withColumn("proximity_status", proximity_status_expr("baro_altitude", low_altitude))
        .drop("_gf_clat", "_gf_clon")
    )


def airport_distance(silver: DataFrame, airports: DataFrame, radius: float = GEOFENCE_RADIUS,
                     low_altitude: float = LOW_ALTITUDE) -> DataFrame:
    """Gold ``airport_distance`` table (L3): the seven published columns."""
    return airport_proximity(silver, airports, radius, low_altitude).select(
        "icao24", "callsign", "airport_name", "dist", "proximity_status", "flight_time", "processed_at"
    )
