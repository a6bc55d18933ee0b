"""Date dimension (I6-I10, D17), date-part joins (C4) and date-level roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flightlake.fixed import CALENDAR_YEARS
from flightlake.functions.columns import safe_cast
from flightlake.functions.dates import calendar_columns


def calendar_for(df: DataFrame, time_col: str, years: tuple[int, int] = CALENDAR_YEARS) -> DataFrame:
    """Every day from 1 January of the earliest year to 31 December of the latest year in ``time_col``.

    Dates outside ``years`` (a time in milliseconds, say) are no dates of the calendar: they do not stretch it and
    join no day. The bounds are one global aggregate (partial per task); years, then the days of each, are generated from that
    single row, so no array holds more than the days of a year.
    """
    year = F.year(safe_cast(time_col, "date"))
    bounds = df.where(year.between(*years)).agg(F.min(year).alias("_y0"), F.max(year).alias("_y1")).where("_y0 is not null")
    each = bounds.select(F.explode(F.sequence("_y0", "_y1")).alias("_y"))
    days = each.select(F.explode(F.sequence(F.make_date("_y", F.lit(1), F.lit(1)), F.make_date("_y", F.lit(12), F.lit(31)),
                                            F.expr("INTERVAL 1 DAY"))).alias("_d"))
    return days.select(*calendar_columns("_d"))


def join_calendar(df: DataFrame, calendar: DataFrame, time_col: str) -> DataFrame:
    """C4: left join on the date part only; text that is no date joins nothing."""
    cal = calendar.withColumnRenamed("date", "_cal_date")
    joined = df.join(cal, safe_cast(time_col, "date") == F.col("_cal_date"), "left")
    return joined.withColumnRenamed("_cal_date", "date")


def rollup_by_date(df: DataFrame, calendar: DataFrame, time_col: str) -> DataFrame:
    """Row counts at every level of Year > Quarter > Month > Day plus the grand total.

    Rows are counted per day first (combined map-side), so the calendar join and the rollup, which repeats each
    row for every level, see one row per day.
    """
    days = df.groupBy(safe_cast(time_col, "date").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    joined = join_calendar(days, calendar, "_day")
    return joined.rollup("year", "quarter_no", "month_no", "day").agg(F.sum("_n").alias("flight_rows"))


def month_axis(calendar: DataFrame) -> DataFrame:
    """month labels in calendar order (sorted by month number, not by name)."""
    return calendar.select("month_no", "month").distinct().orderBy("month_no")


def quarter_axis(calendar: DataFrame) -> DataFrame:
    """quarter labels sorted by quarter number."""
    return calendar.select("quarter_no", "quarter").distinct().orderBy("quarter_no")


def flights_of_days(stored: DataFrame, calendar: DataFrame, partition: str = "flight_date") -> DataFrame:
    """C4/D19 over a stored table: its rows of the calendar's days (filter the calendar first), with the calendar's columns.

    The join is on the partition column and has a filtered calendar on its other side, so the scan lists the folders of
    those days alone (dynamic partition pruning). The calendar is a row per day and is broadcast.
    """
    days = calendar.withColumnRenamed("date", "_cal_date")
    joined = stored.join(F.broadcast(days), F.col(partition) == F.col("_cal_date"))
    return joined.withColumnRenamed("_cal_date", "date")
