"""Versioned lake: incremental phases and statistics, one commit for all tables, key filters, compaction."""

import json
import os
import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.operators import stats
from flightlake.operators.dedupe import keep_first
from flightlake.operators.geofence import airport_distance
from flightlake.operators.phase import flight_phase, phase_order
from flightlake.operators.silver import SILVER_KEYS
from flightlake.plans import lake as L
from flightlake.sources import versions
from flightlake.sources.inline import airports_frame
from flightlake.sources.key_filters import build_filters, candidate_files
from flightlake.sources.silver_table import flight_date

TS = datetime(2024, 2, 1)
SCHEMA = schemas.SILVER


def silver(spark, rows):
    """(icao24, seconds as text, altitude, country) rows in the silver layout."""
    full = []
    for key, time, altitude, country in rows:
        sane = time is not None and time.lstrip("-").isdigit() and abs(int(time)) < 10**11
        text = (datetime(1970, 1, 1) + timedelta(seconds=int(time))).strftime("%Y-%m-%d %H:%M:%S") if sane else None
        full.append((key, "CS1", country, time, -0.45 + (hash(time) % 7) / 10, 51.4, altitude, 10.0, None, None, text, TS))
    return spark.createDataFrame(full, SCHEMA)


def random_batches(seed, n_batches=3, n=60):
    rng = random.Random(seed)
    days = [1704067200 + 86400 * d for d in range(6)]
    batches = []
    for b in range(n_batches):
        batch = []
        for _ in range(n):
            key = rng.choice(["a", "a", "a", "b", "c", "d", None, f"x{rng.randint(0, 20)}"])
            late = rng.random() < 0.3
            day = rng.choice(days[: 2 * b + 2] if late else days[2 * b: 2 * b + 2])
            time = rng.choice([str(day + rng.randint(0, 40) * 60)] * 12 + [None, "soon", "99999999999999"])
            batch.append((key, time, rng.choice([None, 100.0, 110.0, 200.0, 900.0]), rng.choice(["X", "Y", None])))
        batches.append(batch)
    return batches


def table(df, *drop):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def whole_phases(rows):
    dated = rows.withColumn("flight_date", flight_date())
    return flight_phase(dated, tiebreak=phase_order(rows.columns)[1:])


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_equal_one_run_over_all_rows(spark, tmp_dir, seed):
    lake = L.Lake.at(f"{tmp_dir}/{seed}")
    batches = random_batches(seed)
    stored = None
    for i, batch in enumerate(batches):
        rows = silver(spark, batch)
        L.append_silver_run(spark, lake, rows, TS + timedelta(hours=i))
        L.update_gold(spark, lake, ts=TS + timedelta(hours=i))
        fresh = keep_first(rows, SILVER_KEYS)
        new = fresh if stored is None else fresh.join(stored, [F.expr("icao24 <=> ik AND time_position <=> tk")], "left_anti")
        stored_rows = new if stored is None else stored_rows.unionByName(new)
        stored = stored_rows.select(F.col("icao24").alias("ik"), F.col("time_position").alias("tk"))
        if i == 1:
            L.compact_silver(spark, lake, TS + timedelta(hours=i))
    assert table(L.read_silver_rows(spark, lake), "flight_date") == table(stored_rows)
    want = whole_phases(stored_rows)
    assert table(L.read_gold(spark, lake, L.PHASES), "processed_at") == table(want, "processed_at")
    got = {r["origin_country"]: r for r in L.latest_run(spark, lake, L.COUNTRIES).collect()}
    for r in stats.country_stats(want.withColumn("processed_at", F.lit("now"))).collect():
        mine = got.pop(r["origin_country"])
        assert (mine["flight_count"], mine["count_climbing"]) == (r["flight_count"], r["count_climbing"])
        assert mine["avg_altitude_m"] == pytest.approx(r["avg_altitude_m"]) and mine["avg_speed_ms"] == pytest.approx(r["avg_speed_ms"])
    assert not got
    assert [tuple(r)[1] for r in L.read_gold(spark, lake, L.SUMMARY).collect()] == [stored_rows.count()]
    near = airport_distance(stored_rows, airports_frame(spark))
    assert table(L.read_gold(spark, lake, L.DISTANCES), "processed_at") == table(near, "processed_at")


def test_run_on_time_reads_new_parts_and_state_only(spark, tmp_dir, monkeypatch):
    lake = L.Lake.at(tmp_dir)
    base = 1704067200
    L.append_silver_run(spark, lake, silver(spark, [("a", str(base + i), 100.0 * i, "X") for i in range(5)]), TS)
    L.update_gold(spark, lake, ts=TS)
    read = []
    real = versions.read_parts

    def noted(spark_, base_, name, parts, schema):
        parts = list(parts)
        read.extend((name, p.seq) for p in parts)
        return real(spark_, base_, name, parts, schema)

    monkeypatch.setattr(versions, "read_parts", noted)
    L.append_silver_run(spark, lake, silver(spark, [("a", str(base + 86400), 100.0, "X")]), TS + timedelta(hours=1))
    assert not [x for x in read if x[0] == L.SILVER]
    L.update_gold(spark, lake, ts=TS + timedelta(hours=1))
    assert [x for x in read if x[0] in (L.SILVER, L.PHASES)] == [(L.SILVER, 2), (L.PHASES, 2)]
    # A late row opens its own day and the day of the row behind it, and no other.
    L.append_silver_run(spark, lake, silver(spark, [("a", str(base + 86400 * 9), 5.0, "X")]), TS + timedelta(hours=2))
    L.update_gold(spark, lake, ts=TS + timedelta(hours=2))
    read.clear()
    L.append_silver_run(spark, lake, silver(spark, [("a", str(base + 2), None, "X"), ("a", str(base + 60), 7.0, "X")]), TS + timedelta(hours=3))
    L.update_gold(spark, lake, ts=TS + timedelta(hours=3))
    assert {s for t, s in read if t == L.PHASES} == {1, 2, 4}
    rows = L.read_gold(spark, lake, L.PHASES).orderBy("flight_time").select("time_position", "prev_alt").collect()
    assert [(int(r[0]) - base, r[1]) for r in rows][-3:] == [(60, 400.0), (86400, 7.0), (86400 * 9, 100.0)]


def test_a_stopped_run_leaves_the_old_one(spark, tmp_dir, monkeypatch):
    lake = L.Lake.at(tmp_dir)
    first, second = random_batches(9, 2, 15)
    L.append_silver_run(spark, lake, silver(spark, first), TS)
    L.update_gold(spark, lake, ts=TS)
    tables = (L.PHASES, L.STATE, L.PARTIALS, L.COUNTRIES, L.SUMMARY, L.DISTANCES)
    before = {t: table(L.read_gold(spark, lake, t), "aircraft") for t in tables}
    L.append_silver_run(spark, lake, silver(spark, second), TS + timedelta(hours=1))
    real = versions.write_parts
    for stop in (L.PHASES, L.EDGES, L.STATE, L.PARTIALS, L.COUNTRIES, L.SUMMARY, L.DISTANCES):

        def stopped(df, base, name, *rest):
            out = real(df, base, name, *rest)
            if name == stop:
                raise KeyboardInterrupt
            return out

        with monkeypatch.context() as patched:
            patched.setattr(versions, "write_parts", stopped)
            with pytest.raises(KeyboardInterrupt):
                L.update_gold(spark, lake, ts=TS + timedelta(hours=1))
        now = versions.current(spark, lake.gold)
        assert now.seq == 1 and all(p.seq == 1 for parts in now.parts.values() for p in parts)
    assert {t: table(L.read_gold(spark, lake, t), "aircraft") for t in tables} == before
    L.update_gold(spark, lake, ts=TS + timedelta(hours=1))  # tried again, it is the run it would have been
    n = L.read_silver_rows(spark, lake).count()
    assert L.read_gold(spark, lake, L.PHASES).count() == n
    assert L.read_gold(spark, lake, L.SUMMARY).first()["total_global_flights"] == n
    assert L.update_gold(spark, lake, ts=TS + timedelta(hours=2)).seq == 2  # nothing new, no commit


def test_a_second_writer_is_refused(spark, tmp_dir):
    version = versions.Version(1)
    versions.commit(spark, tmp_dir, version)
    with pytest.raises(RuntimeError):
        versions.commit(spark, tmp_dir, version)
    assert versions.current(spark, tmp_dir).seq == 1 and versions.current(spark, f"{tmp_dir}/none").seq == 0


def test_append_opens_only_files_that_may_hold_a_key(spark, tmp_dir):
    lake = L.Lake.at(tmp_dir)
    base = 1704067200
    for day in range(12):
        L.append_silver_run(spark, lake, silver(spark, [(f"p{i}", str(base + 86400 * day + i), 1.0, "X") for i in range(200)]), TS + timedelta(days=day))
    now = versions.current(spark, lake.silver)

    def opened(rows):
        return L.files_with_keys(spark, lake.silver, now, silver(spark, rows).withColumn("flight_date", flight_date()))

    hour = [(f"p{i}", str(base + 86400 * 11 + 3600 + i), 1.0, "X") for i in range(200)]
    odd = [("p1", str(base + 86400 * d + 50), 1.0, "X") for d in (0, 3, 5)]
    assert opened(hour + odd) == []
    held = opened(hour + odd + [("p7", str(base + 86400 * 3 + 7), 1.0, "X")])
    assert len(held) == 1 and "flight_date=2024-01-04" in held[0]
    assert opened([("p1", None, 1.0, "X"), ("p1", "soon", 1.0, "X")]) == []


def test_filters_miss_no_key(spark, tmp_dir):
    rng = random.Random(4)
    rows = silver(spark, [(rng.choice([None, f"k{i}", "same"]), rng.choice([None, "x", str(1704067200 + i)]), None, None) for i in range(4000)])
    dated = rows.withColumn("flight_date", flight_date())
    parts = versions.write_parts(dated.repartition(3), tmp_dir, "t", "r1", 1)
    stored = versions.read_parts(spark, tmp_dir, "t", parts, dated.schema)
    root = f"{tmp_dir}/t"
    scan = spark.read.schema(dated.schema).option("basePath", root).parquet(*[f"{root}/{p.place}" for p in parts])
    filters = build_filters(scan, SILVER_KEYS, "time_position").cache()
    files = {r["file"] for r in filters.select("file").distinct().collect()}
    assert len(files) == sum(p.files for p in parts)
    assert filters.where("blocks > 1").count() > 0
    for row in stored.sample(0.002, 3).collect():
        own = spark.createDataFrame([row], dated.schema)
        assert candidate_files(own, filters, SILVER_KEYS, "time_position").count() >= 1
    others = dated.withColumn("icao24", F.concat(F.lit("other"), F.monotonically_increasing_id().cast("string")))
    hit = candidate_files(others.limit(20), filters, SILVER_KEYS, "time_position").count()
    assert hit <= 1
    filters.unpersist()


def test_one_file_a_day_and_compaction(spark, tmp_dir):
    lake = L.Lake.at(tmp_dir)
    base = 1704067200
    for hour in range(3):
        rows = [(f"p{i}", str(base + 86400 * (i % 31) + 3600 * hour + i), 1.0 * i, "X") for i in range(310)]
        L.append_silver_run(spark, lake, silver(spark, rows).repartition(8), TS + timedelta(hours=hour))
        L.update_gold(spark, lake, ts=TS + timedelta(hours=hour))
    now = versions.current(spark, lake.silver)
    assert [sum(p.files for p in now.parts[L.SILVER] if p.seq == s) for s in (1, 2, 3)] == [31, 31, 31]
    before = table(L.read_silver_rows(spark, lake))
    packed = L.compact_silver(spark, lake, TS)
    assert packed.seq == 4 and sum(p.files for p in packed.parts[L.SILVER]) == 31 and len(packed.parts[L.FILTERS]) == 31
    assert table(L.read_silver_rows(spark, lake)) == before
    assert table(versions.read_table(spark, lake.silver, L.SILVER, now)) == before  # readers of the old version
    assert L.compact_silver(spark, lake, TS).seq == 4
    again = [("p5", str(base + 86400 * 5 + 5), 1.0, "X"), ("p5", str(base + 86400 * 5 + 6), 1.0, "X")]
    L.append_silver_run(spark, lake, silver(spark, again), TS + timedelta(hours=9))
    assert L.read_silver_rows(spark, lake).count() == len(before) + 1
    assert L.update_gold(spark, lake, ts=TS + timedelta(hours=9)).facts["silver_seq"] == 5
    assert L.read_gold(spark, lake, L.SUMMARY).first()["total_global_flights"] == len(before) + 1


def landed(folder, name, rows, age_days=0):
    """A landing file of (icao24, seconds, altitude) states, with a time stamp some days back."""
    os.makedirs(folder, exist_ok=True)
    states = [[k, "CS1", "X", None, t, 1.0, 2.0, a, False, 10.0] + [None] * 7 for k, t, a in rows]
    path = f"{folder}/{name}.json"
    with open(path, "w") as out:
        out.write(json.dumps({"time": 1704067200, "states": states}) + "\n")
    when = time.time() - 86400 * age_days
    os.utime(path, (when, when))


def test_an_hour_reads_its_own_landing_files_alone(spark, tmp_dir, monkeypatch):
    raw, base, read = f"{tmp_dir}/raw", 1704067200, []
    real = L.append_silver_run

    def noted(spark_, lake_, rows, ts=None):
        read.append(sorted(r["source_file"] for r in rows.select("source_file").distinct().collect()))
        return real(spark_, lake_, rows, ts)

    monkeypatch.setattr(L, "append_silver_run", noted)
    for hour in range(3):
        landed(raw, f"h{hour}", [("a", base + 3600 * hour, 100.0 * hour), ("b", base, 5.0)])
        lake = L.run_hour(spark, raw, f"{tmp_dir}/lake", TS + timedelta(hours=hour))
    assert read == [["h0.json"], ["h1.json"], ["h2.json"]]
    # A file far older than those read before, and one that dies before its checkpoint and is read again.
    landed(raw, "old", [("a", base + 60, 50.0), ("c", base, "n/a")], age_days=400)
    with monkeypatch.context() as patched:

        def stopped(*args):
            noted(*args)
            raise RuntimeError("stopped")

        patched.setattr(L, "append_silver_run", stopped)
        with pytest.raises(Exception):
            L.run_hour(spark, raw, f"{tmp_dir}/lake", TS + timedelta(hours=3))
    lake = L.run_hour(spark, raw, f"{tmp_dir}/lake", TS + timedelta(hours=4))
    assert read[3:] == [["old.json"], ["old.json"]]
    assert L.run_hour(spark, raw, f"{tmp_dir}/lake", TS + timedelta(hours=5)) == lake and len(read) == 5
    rows = L.read_gold(spark, lake, L.PHASES).select("icao24", "time_position", "prev_alt").collect()
    assert sorted((r[0], int(r[1]) - base, r[2]) for r in rows) == [
        ("a", 0, None), ("a", 60, 0.0), ("a", 3600, 50.0), ("a", 7200, 100.0), ("b", 0, None), ("c", 0, None)]
    cells = versions.read_table(spark, lake.silver, L.RESCUES).select("icao24", "raw_text", "source_file").collect()
    assert [tuple(r) for r in cells] == [("c", "n/a", "old.json")]


def test_a_backlog_in_several_commits(spark, tmp_dir):
    raw, base = f"{tmp_dir}/raw", 1704067200
    for i in range(4):
        landed(raw, f"f{i}", [(f"k{i}", base + i, 1.0), ("same", base, 2.0)], age_days=30 * i)
    lake = L.Lake.at(f"{tmp_dir}/lake")
    assert L.append_landed(spark, raw, lake, TS, files_per_commit=1).seq == 4
    assert L.read_silver_rows(spark, lake).count() == 5
    assert L.update_gold(spark, lake, ts=TS).facts["silver_seq"] == 4


def test_gold_is_packed_and_old_versions_expire(spark, tmp_dir):
    lake = L.Lake.at(tmp_dir)
    base = 1704067200
    for hour in range(4):
        rows = [(f"p{i}", str(base + 86400 * (i % 3) + 3600 * hour + i), 40.0 * ((i + hour) % 5), "X" if i % 2 else "Y") for i in range(90)]
        L.append_silver_run(spark, lake, silver(spark, rows), TS + timedelta(hours=hour))
        L.update_gold(spark, lake, ts=TS + timedelta(hours=hour))
    grown = (L.PHASES, L.EDGES, L.PARTIALS)
    whole = L.read_gold(spark, lake, L.PHASES)
    want, now = table(whole), versions.current(spark, lake.gold)
    packed = L.compact_gold(spark, lake, TS)
    assert packed.seq == now.seq + 1 and L.compact_gold(spark, lake, TS).seq == packed.seq
    assert {t: len(packed.parts[t]) for t in grown} == {t: 3 for t in grown}
    assert table(L.read_gold(spark, lake, L.PHASES)) == want
    assert L.read_gold(spark, lake, L.PARTIALS).count() == 6 and L.read_gold(spark, lake, L.EDGES).count() == 90
    assert stats.aircraft_estimate(L.read_gold(spark, lake, L.PARTIALS), ["origin_country"]).count() == 2
    # Folders that a dead run left, and those that were replaced, go; kept versions stay whole.
    orphan = L.read_gold(spark, lake, L.STATE)
    versions.write_parts(orphan, lake.gold, L.STATE, f"dead-{packed.seq:06d}", packed.seq, by_day=False)
    versions.write_parts(orphan, lake.gold, L.STATE, f"coming-{packed.seq + 1:06d}", packed.seq + 1, by_day=False)
    assert versions.expire(spark, lake.gold, keep=2) > 0
    assert table(versions.read_table(spark, lake.gold, L.PHASES, now)) == want
    versions.expire(spark, lake.gold)
    assert versions.expire(spark, lake.gold) == 0
    assert table(L.read_gold(spark, lake, L.PHASES)) == want
    left = sorted(os.listdir(f"{lake.gold}/{L.STATE}"))
    assert len(left) == 2 and left[0] == f"run=coming-{packed.seq + 1:06d}"
    assert len(L.read_gold(spark, lake, L.COUNTRIES).select("processed_at").distinct().collect()) == 4
    with pytest.raises(ValueError):
        versions.expire(spark, lake.gold, keep=0)
    # A late row after packing and expiry finds its neighbours.
    L.append_silver_run(spark, lake, silver(spark, [("p3", str(base + 5), 7.0, "X")]), TS + timedelta(hours=9))
    L.update_gold(spark, lake, ts=TS + timedelta(hours=9))
    assert table(L.read_gold(spark, lake, L.PHASES), "processed_at") == table(whole_phases(
        L.read_silver_rows(spark, lake).drop("flight_date")), "processed_at")
    partials = L.read_gold(spark, lake, L.PARTIALS)
    assert L.read_gold(spark, lake, L.SUMMARY).first()["total_global_flights"] == 361
    assert partials.agg(F.sum("row_count")).first()[0] == 361
    assert versions.expire(spark, f"{tmp_dir}/none") == 0


def test_aircraft_of_any_span_from_sketches(spark, tmp_dir):
    lake = L.Lake.at(tmp_dir)
    base = 1704067200
    rows = [(f"p{i % 700}", str(base + 86400 * (i % 9) + i), 1.0, "X" if i % 2 else "Y") for i in range(3000)]
    L.append_silver_run(spark, lake, silver(spark, rows), TS)
    L.update_gold(spark, lake, ts=TS)
    partials = L.read_gold(spark, lake, L.PARTIALS)
    for first, last in ((0, 8), (2, 4), (5, 5)):
        span = F.col("flight_date").between(date(2024, 1, 1 + first), date(2024, 1, 1 + last))
        want = len({k for k, t, _, _ in rows if first <= (int(t) - base) // 86400 <= last})
        got = stats.aircraft_estimate(partials.where(span)).first()["aircraft"]
        assert abs(got - want) <= 4 * 0.0163 * want
    by = {r["origin_country"]: r["aircraft"] for r in stats.aircraft_estimate(partials, ["origin_country"]).collect()}
    assert set(by) == {"X", "Y"} and all(abs(n - 350) <= 4 * 0.0163 * 350 for n in by.values())


def test_empty_runs(spark, tmp_dir):
    lake = L.Lake.at(tmp_dir)
    assert L.append_silver_run(spark, lake, silver(spark, []), TS).seq == 0
    assert L.update_gold(spark, lake, ts=TS).seq == 0 and L.compact_silver(spark, lake, TS).seq == 0
    with pytest.raises(ValueError):
        L.read_gold(spark, lake, L.PHASES)
