"""Scalar column expressions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flightlake.fixed import (
    LOW_ALTITUDE,
    PHASE_CLIMBING,
    PHASE_CRUISING,
    PHASE_DELTA,
    PHASE_DESCENDING,
    PHASE_INITIALIZING,
    STATUS_LOW,
    STATUS_PASSING,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def state_field(states_col: str | Column, position: int) -> Column:
    """Element ``position`` (0-based) of a state array; NULL when the array is shorter or NULL.

    ``F.get`` never raises, unlike ``col[i]`` under ANSI mode.
    """
    return F.get(_col(states_col), F.lit(position))


def safe_cast(c: str | Column, kind: str) -> Column:
    """Cast that yields NULL for text that does not parse (no failure under ANSI mode)."""
    return _col(c).try_cast(kind)


def epoch_to_text(epoch_seconds: str | Column) -> Column:
    """Epoch seconds (number or numeric text) -> 'yyyy-MM-dd HH:mm:ss' in the session zone."""
    return F.from_unixtime(_col(epoch_seconds).try_cast("bigint"))


def planar_distance(lat: str | Column, lon: str | Column, lat_ref: str | Column, lon_ref: str | Column) -> Column:
    """Euclidean distance in degrees (no latitude scaling, no antimeridian wrap)."""
    return F.sqrt(F.pow(_col(lat) - _col(lat_ref), 2) + F.pow(_col(lon) - _col(lon_ref), 2))


def flight_phase_expr(altitude: str | Column, previous: str | Column, delta: float = PHASE_DELTA) -> Column:
    """Classify an altitude against the previous one.

    NULL previous -> Initializing; more than ``delta`` above -> Climbing; more than ``delta`` below ->
    Descending; anything else (including a NULL current altitude) -> Cruising.
    """
    alt, prev = _col(altitude), _col(previous)
    return (
        F.when(prev.isNull(), F.lit(PHASE_INITIALIZING))
        .when(alt > prev + F.lit(delta), F.lit(PHASE_CLIMBING))
        .when(alt < prev - F.lit(delta), F.lit(PHASE_DESCENDING))
        .otherwise(F.lit(PHASE_CRUISING))
    )


def proximity_status_expr(altitude: str | Column, low_altitude: float = LOW_ALTITUDE) -> Column:
    """Below ``low_altitude`` -> landing / taking off; otherwise (NULL included) -> passing over."""
    return F.when(_col(altitude) < F.lit(low_altitude), F.lit(STATUS_LOW)).otherwise(F.lit(STATUS_PASSING))
