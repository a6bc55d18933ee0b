"""Clustering by place: tables whose files each cover a small area, so box and geofence scans pass over the others.

Rows are ordered by a Morton code, which interleaves the bits of latitude and longitude, and dealt out by ranges of it. Each file
and row group then holds a narrow range of both coordinates, and the statistics that parquet keeps anyway let a filter on
them skip the rest. Rows without a place, or off the globe, have no code and come first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.fixed import GEOFENCE_RADIUS
from flightlake.operators.geofence import airport_proximity

# Bits of a coordinate in the code: cells of 0.0027 degrees of latitude.
CODE_BITS = 16
# Airports whose boxes make one scan filter; with more the scan reads all files and the join alone decides.
MAX_BOXES = 64
# Shift and mask that spread 16 bits to every other bit of 32: fixed values.
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(x: Column) -> Column:
    for shift, mask in SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def morton_code(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Latitude in the odd bits, longitude in the even ones; NULL without a place on the globe."""
    def cell(value: Column, low: float, span: float) -> Column:
        steps = F.lit((1 << CODE_BITS) - 1)
        return F.floor((value - F.lit(low)) / F.lit(span) * steps)

    y, x = F.col(lat), F.col(lon)
    on_globe = y.between(-90.0, 90.0) & x.between(-180.0, 180.0)
    code = F.shiftleft(_spread(cell(y, -90.0, 180.0)), 1).bitwiseOR(_spread(cell(x, -180.0, 360.0)))
    return F.when(on_globe, code)


def clustered(df: DataFrame, files: int | None = None, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``df`` in Morton order: ranges of the code per task (``files`` of them; default: the shuffle partitions), sorted in each.

    Range bounds are sampled; rows of one code (a parked aircraft) stay together with ``files`` given, so the
    other columns break the tie and a code with very many rows is cut as well.
    """
    code = "_morton"
    coded = df.withColumn(code, morton_code(lat, lon))
    spread = [c for c in coded.columns if dict(coded.dtypes)[c] in ("string", "bigint", "int", "double", "timestamp", "timestamp_ntz")]
    keys = [code, *[c for c in spread if c not in (code, lat, lon)][:2]]
    ranged = coded.repartitionByRange(files, *keys) if files else coded.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(code).drop(code)


def in_boxes(boxes: list[tuple[float, float, float, float]], lat: str = "latitude", lon: str = "longitude") -> Column:
    """Inside one of some (south, north, west, east) boxes: comparisons with literals, which the scan can use."""
    return reduce(lambda a, b: a | b, [F.col(lat).between(s, n) & F.col(lon).between(w, e) for s, n, w, e in boxes])


def proximity_pruned(flights: DataFrame, airports: DataFrame, radius: float = GEOFENCE_RADIUS, **options) -> DataFrame:
    """``airport_proximity`` over a clustered table: the scan is limited to boxes around the airports first.

    The airports are read to the driver up to ``MAX_BOXES`` of them (one more is asked for, to know); with more there is no box filter.
    A box is wider than the radius by a little, so rounding loses no pair.
    """
    at = airports.select("lat_ref", "lon_ref").where("lat_ref is not null and lon_ref is not null").limit(MAX_BOXES + 1).collect()
    if 0 < len(at) <= MAX_BOXES:
        wide = radius * (1 + 1e-9)
        flights = flights.where(in_boxes([(r[0] - wide, r[0] + wide, r[1] - wide, r[1] + wide) for r in at]))
    return airport_proximity(flights, airports, radius, **options)
