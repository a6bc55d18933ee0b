"""Silver cleaning (L1): null filter before trim, safe casts, time text, de-duplication."""

from pyspark.sql import functions as F

from flightlake.operators.silver import legacy_to_current, to_silver


def _raw(spark, states_per_doc):
    return spark.createDataFrame(
        [(t, states) for t, states in states_per_doc], "time BIGINT, states ARRAY<ARRAY<STRING>>"
    )


def _state(icao, callsign, t, lon="1.0", lat="2.0", alt="100.0", vel="50", last=None):
    # positions 0..11 ; position 4 (last_contact) is what the silver job publishes as time_position
    return [icao, callsign, "X", t, last if last is not None else t, lon, lat, alt, "false", vel, "90", "0"]


def test_callsign_rules_and_types(spark):
    raw = _raw(spark, [(1, [
        _state("a1", None, "1700000000"),
        _state("a2", "        ", "1700000001"),
        _state("a3", "BAW1  ", "1700000002", lon="abc"),
    ])])
    out = {r.icao24: r for r in to_silver(raw, F.lit("2024-02-01").cast("timestamp")).collect()}
    assert set(out) == {"a2", "a3"}
    assert out["a2"].callsign == "" and out["a3"].callsign == "BAW1"
    assert out["a3"].longitude is None and out["a3"].latitude == 2.0 and out["a3"].velocity == 50.0
    assert out["a3"].time_position == "1700000002"
    assert out["a3"].flight_time == "2023-11-14 22:13:22"


def test_drop_blank_and_null_coordinates(spark):
    raw = _raw(spark, [(1, [_state("a2", "        ", "1"), _state("a3", "X", "2", lat=None)])])
    assert to_silver(raw, drop_blank=True).count() == 1
    assert to_silver(raw, drop_null_coords=True).count() == 1


def test_time_index_and_dedupe(spark):
    raw = _raw(spark, [
        (1, [_state("a1", "B", "100", last="200"), _state("a1", "A", "101", last="200")]),
        (2, [_state("a1", "C", "102", last="200"), _state("a1", "D", None, last=None),
             _state("a1", "E", None, last=None)]),
    ])
    by_last = to_silver(raw).collect()
    # (a1, 200) three times -> one survivor, the smallest row; (a1, NULL) twice -> one (NULL keys equal)
    assert len(by_last) == 2
    assert {r.callsign for r in by_last} == {"A", "D"}
    by_true_time = to_silver(raw, time_index=3).collect()
    assert sorted((r.time_position or "") for r in by_true_time) == ["", "100", "101", "102"]


def test_dedupe_is_idempotent(spark):
    raw = _raw(spark, [(1, [_state("a1", "A", "1"), _state("a1", "A", "1"), _state("a2", "B", "1")])])
    once = to_silver(raw, F.lit(None).cast("timestamp"))
    twice = once.unionByName(once).transform(
        lambda d: d.groupBy(d.columns).count().drop("count")
    )
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_legacy_rename(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "long DOUBLE, lat DOUBLE")
    assert legacy_to_current(df).columns == ["longitude", "latitude"]


def test_report_declared_types_and_rename(spark):
    from flightlake.operators.silver import declared_types, report_silver
    df = spark.createDataFrame(
        [("a1", "BAW1", "7700", "0042", "51.5", "-0.1", "2024-01-01 10:00:00", "x")],
        "icao24 STRING, callsign STRING, squawk STRING, time_position STRING, lat STRING, long STRING, "
        "flight_time STRING, extra STRING",
    )
    row = report_silver(df).collect()[0]
    # declared order, unknown columns dropped, text parsed with try_cast, names updated
    # declared columns that the table lacks are NULL columns of their type
    declared = report_silver(df)
    assert declared.columns == ["icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
                                "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "sensors",
                                "geo_altitude", "squawk", "spi", "position_source", "flight_time", "processed_at"]
    assert dict(declared.dtypes)["geo_altitude"] == "double" and row.geo_altitude is None
    assert row.squawk == 7700 and row.time_position == 42 and row.latitude == 51.5 and row.longitude == -0.1
    assert str(row.flight_time) == "2024-01-01 10:00:00"
    bad = spark.createDataFrame([("n/a",)], "squawk STRING")
    assert declared_types(bad).collect()[0].squawk is None
