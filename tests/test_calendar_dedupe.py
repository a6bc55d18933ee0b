"""Calendar (I6-I10, C4, D19) and de-duplication / repeat-safe append."""

from datetime import date, datetime

from flightlake.operators.calendar import calendar_for, join_calendar, rollup_by_date
from flightlake.operators.dedupe import append_unique, duplicate_count, keep_first


def test_calendar_spans_whole_years_with_leap_day(spark):
    df = spark.createDataFrame([(datetime(2023, 6, 5, 10),), (datetime(2024, 2, 29, 23, 59),)], "t TIMESTAMP_NTZ")
    cal = calendar_for(df, "t")
    rows = {r.date: r for r in cal.collect()}
    assert len(rows) == 365 + 366
    leap = rows[date(2024, 2, 29)]
    assert (leap.year, leap.month_no, leap.month, leap.quarter_no, leap.quarter, leap.day) == (
        2024, 2, "February", 1, "Qtr 1", 29)
    assert rows[date(2023, 12, 31)].quarter == "Qtr 4"
    joined = join_calendar(df, cal, "t").collect()
    assert {r.date for r in joined} == {date(2023, 6, 5), date(2024, 2, 29)}
    roll = rollup_by_date(df, cal, "t").collect()
    # 2 days + 2 months + 2 quarters + 2 years + grand total
    assert len(roll) == 9
    assert [r.flight_rows for r in roll if r.year is None] == [2]


def test_keep_first_and_duplicate_count(spark):
    df = spark.createDataFrame(
        [("a", 1, 3, "z"), ("a", 1, 2, "y"), ("a", 1, 2, "x"), ("b", None, 9, "q"), ("b", None, 8, "r")],
        "k STRING, t BIGINT, eid BIGINT, v STRING")
    kept = {(r.k, r.t): (r.eid, r.v) for r in keep_first(df, ["k", "t"], ["eid"]).collect()}
    assert kept == {("a", 1): (2, "x"), ("b", None): (8, "r")}
    d = duplicate_count(df, ["k", "t"]).first()
    assert (d.total_rows, d.distinct_keys, d.duplicate_rows) == (5, 2, 3)


def test_duplicate_count_of_no_rows_is_zero(spark):
    d = duplicate_count(spark.createDataFrame([], "k STRING, t BIGINT"), ["k", "t"]).first()
    assert (d.total_rows, d.distinct_keys, d.duplicate_rows) == (0, 0, 0)


def test_calendar_with_text_that_is_no_date(spark):
    df = spark.createDataFrame([("2024-02-29 10:00:00",), ("n/a",), (None,), ("2024-02-30",)], "t STRING")
    cal = calendar_for(df, "t")
    assert cal.count() == 366
    assert sorted(str(r.date) for r in join_calendar(df, cal, "t").collect()) == ["2024-02-29", "None", "None", "None"]
    total = [r.flight_rows for r in rollup_by_date(df, cal, "t").collect() if r.day == 29]
    assert total == [1] and rollup_by_date(df, cal, "t").agg({"flight_rows": "max"}).first()[0] == 4


def test_append_twice_equals_once(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", None, 3)], "k STRING, t BIGINT, eid BIGINT")
    first = keep_first(df, ["k", "t"], ["eid"])
    again = append_unique(first, df, ["k", "t"], ["eid"])
    assert again.count() == 0  # NULL key matched NULL-safely
    new = spark.createDataFrame([("c", 5, 4), ("a", 1, 0)], "k STRING, t BIGINT, eid BIGINT")
    assert [tuple(r) for r in append_unique(first, new, ["k", "t"]).collect()] == [("c", 5, 4)]


def test_keep_first_plan_combines_map_side(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "id % 3 AS t", "id AS eid")
    plan = keep_first(df, ["k", "t"], ["eid"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_label_axes_sort_by_number(spark):
    from flightlake.operators.calendar import month_axis, quarter_axis
    df = spark.createDataFrame([(datetime(2024, 3, 1),)], "t TIMESTAMP_NTZ")
    cal = calendar_for(df, "t")
    assert [r.month for r in month_axis(cal).collect()][:4] == ["January", "February", "March", "April"]
    assert [r.quarter for r in quarter_axis(cal).collect()] == ["Qtr 1", "Qtr 2", "Qtr 3", "Qtr 4"]
