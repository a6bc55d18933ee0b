"""Calendar attribute expressions (date dimension columns)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flightlake.fixed import QUARTER_PREFIX


def calendar_columns(date_col: str | Column) -> list[Column]:
    """Year > quarter > month > day attributes of a DATE column, in the report's column names."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return [
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.quarter(d).alias("quarter_no"),
        F.concat(F.lit(QUARTER_PREFIX), F.quarter(d).cast("string")).alias("quarter"),
        F.dayofmonth(d).alias("day"),
    ]
