"""Per-aircraft previous value (E1) and flight phase (E2), safe for hot aircraft.

A plain ``lag`` over ``Window.partitionBy(icao24)`` sends every row of one aircraft to one task. That is the
best plan (one shuffle, one sort) for every aircraft whose rows fit a task, and a bad one for an aircraft that
holds a large share of all rows. So rows are counted per key first (a hash aggregation of the key columns alone,
combined map-side, written to the shared folder):

1. Keys of at most ``hot_rows`` rows: the plain window.
2. Hot keys: their rows are range-partitioned on (key, order), sorted, cut every ``hot_rows`` rows into parts and
   written once, so one key is spread over many tasks; ``lag`` runs per (key, part), and the first row of a part
   takes the last value of the key's previous part (one row per key and part). A task of the range shuffle holds
   many parts where parts are small: its number of tasks follows the rows, not the parts.

The result equals ``lag(value) OVER (PARTITION BY key ORDER BY order_cols)`` exactly. Both sides of the range
split and the window use Spark's own ordering (NULL first, NaN last), so any ordering type will do. NULL keys keep
their own partition, as in the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from flightlake.fixed import PHASE_DELTA
from flightlake.functions.columns import flight_phase_expr
from flightlake.session import materialize
from flightlake.sources.versions import DAY, days_of

# Rows one key may hold before its rows are spread over several tasks.
DEFAULT_HOT_ROWS = 2_000_000
# Rows of a broadcast routing or carry table (a key, and a value). Beyond this bound the joins are shuffled.
MAX_BROADCAST_ROWS = 100_000
# Rows of hot keys that a task of the range shuffle gets at least, in whole parts: small parts share a task and a file.
RANGE_TASK_ROWS = 100_000


def _lag_hot(rows: DataFrame, order_cols: Sequence[str], value_col: str, out_col: str, hot_rows: int, tasks: int,
             small: bool) -> DataFrame:
    """Rows of hot keys: range shuffle on (key, order), parts of ``hot_rows`` rows, lag per part, carry across parts.

    Range bounds are sampled on the full sort key, so a key is cut wherever its rows are dense. A task sorts its range
    and cuts it every ``hot_rows`` rows; a row's place (rising along the total order, over tasks too) is written with it,
    so rows with equal sort keys have one order from there on. Along that order the part never decreases, so
    the previous part of the same key holds the previous rows. The parted rows are written once to
    the shared folder: places and parts are fixed there (one sampling, one range shuffle), and the
    per-part summary reads only the narrow columns back.
    """
    place = F.col("_lg_i")
    in_task = F.shiftrightunsigned(F.shiftleft(place, 31), 31)  # the low 33 bits: the row's number in its task
    ranged = materialize(
        rows.repartitionByRange(tasks, "_lg_k", *order_cols).sortWithinPartitions("_lg_k", *order_cols)
        .withColumn("_lg_i", F.monotonically_increasing_id())
        .withColumn("_lg_p", place - in_task % F.lit(hot_rows)),
        "lag-hot-rows",
    )
    by_part = Window.partitionBy("_lg_k").orderBy("_lg_p")
    part_last = ranged.groupBy("_lg_k", "_lg_p").agg(F.max_by(value_col, "_lg_i").alias("_lg_last"))
    carry = part_last.select("_lg_k", "_lg_p", F.lag("_lg_last").over(by_part).alias("_lg_carry"))
    joined = ranged.join(F.broadcast(carry) if small else carry, ["_lg_k", "_lg_p"], "left")
    w = Window.partitionBy("_lg_k", "_lg_p").orderBy("_lg_i")
    prev = F.when(F.row_number().over(w) == 1, F.col("_lg_carry")).otherwise(F.lag(value_col).over(w))
    return joined.withColumn(out_col, prev)


def lag_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    value_col: str,
    out_col: str,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """Add ``out_col`` = previous ``value_col`` of the same key in ``order_cols`` order (NULL first)."""
    keys, order_cols = list(keys), list(order_cols)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return rows.withColumn(out_col, F.lag(value_col).over(w))

    # The totals over hot keys are observed while their (short) list is written: no extra job. A struct key
    # treats NULL fields as equal, so NULL keys are routed like any other.
    seen = Observation("lag-hot-keys")
    hot = materialize(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_lg_n"))
        .filter(F.col("_lg_n") > F.lit(hot_rows))
        .select(F.struct(*keys).alias("_lg_k"), "_lg_n")
        .observe(seen, F.count(F.lit(1)).alias("keys"), F.sum("_lg_n").alias("rows")),
        "lag-hot-keys",
    )
    n_hot, hot_total = seen.get["keys"], seen.get["rows"]
    if not n_hot:
        return plain(df).select(*df.columns, out_col)

    parts = max(1, -(-int(hot_total) // hot_rows))
    tasks = max(1, -(-int(hot_total) // max(hot_rows, RANGE_TASK_ROWS)))
    # Parts, tasks and keys are all contiguous ranges of one order, so there are at most as many carry rows as of these together.
    small = n_hot + parts + tasks <= MAX_BROADCAST_ROWS
    hot_keys = F.broadcast(hot.select("_lg_k")) if small else hot.select("_lg_k")
    keyed = df.withColumn("_lg_k", F.struct(*keys))
    cold = plain(keyed.join(hot_keys, "_lg_k", "left_anti"))
    warm = _lag_hot(keyed.join(hot_keys, "_lg_k", "left_semi"), order_cols, value_col, out_col, hot_rows, tasks, small)
    return cold.select(*df.columns, out_col).unionByName(warm.select(*df.columns, out_col))


def flight_phase(
    df: DataFrame,
    key: str = "icao24",
    time_col: str = "flight_time",
    tiebreak: Sequence[str] = (),
    altitude_col: str = "baro_altitude",
    delta: float = PHASE_DELTA,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """Add ``prev_alt`` and ``flight_phase`` (Initializing / Climbing / Descending / Cruising)."""
    lagged = lag_by_key(df, [key], [time_col, *tiebreak], altitude_col, "prev_alt", hot_rows)
    return lagged.withColumn("flight_phase", flight_phase_expr(altitude_col, "prev_alt", delta))


def phase_order(columns: Sequence[str], key: str = "icao24", time_col: str = "flight_time") -> list[str]:
    """An order of an aircraft's rows that no partitioning changes: time, then every other column.

    The batch stamp and the day are no part of it: rows that differ in these alone have the same altitude, so any
    order of them gives the same phases.
    """
    first = [time_col, *[c for c in ("time_position",) if c in columns]]
    return first + [c for c in columns if c not in (key, "processed_at", DAY, *first)]


def _place(columns: Sequence[str], key: str) -> Column:
    return F.struct(*phase_order(columns, key))


def edges_of(rows: DataFrame, key: str = "icao24") -> DataFrame:
    """First and last place (the whole order key) of each aircraft and day. Edges of appended rows merge by min and max."""
    at = _place(rows.columns, key)
    return rows.groupBy(key, DAY).agg(F.min(at).alias("first"), F.max(at).alias("last")).select(key, "first", "last", DAY)


def merge_edges(edges: DataFrame, key: str = "icao24") -> DataFrame:
    """Edges of several runs as one row per aircraft and day."""
    return edges.groupBy(key, DAY).agg(F.min("first").alias("first"), F.max("last").alias("last")).select(key, "first", "last", DAY)


def latest_of(edges: DataFrame, key: str = "icao24") -> DataFrame:
    """The state carried from run to run: the last place of each aircraft, its altitude included."""
    return edges.groupBy(key).agg(F.max("last").alias("last"))


@dataclass(frozen=True)
class PhaseUpdate:
    """``rows``: what to write, with ``prev_alt``, ``flight_phase`` and the stamp of rows taken over unchanged
    (``_old_stamp``). ``rewritten``: days that these rows hold whole and whose stored parts they replace; rows of all other
    days are added to what is stored."""

    rows: DataFrame
    rewritten: set[str]


def update_phases(new: DataFrame, edges: DataFrame, state: DataFrame | None, old_edges: DataFrame | None,
                  stored_days: Callable[[set[str]], DataFrame], key: str = "icao24", altitude_col: str = "baro_altitude",
                  delta: float = PHASE_DELTA, hot_rows: int = DEFAULT_HOT_ROWS) -> PhaseUpdate:
    """Phases of ``new`` silver rows (with their day) as if all rows so far had been ordered together.

    ``edges`` are those of ``new``, ``state`` and ``old_edges`` those stored by the runs before, and ``stored_days`` reads the
    stored phases of some days. An aircraft whose new rows all come after its state carries on from it. An aircraft with a
    late row has the days of its new rows worked out again, and the first day after each, whose first row has another
    predecessor now; such stored days are replaced whole, the rows of other aircraft taken over as they are.
    """
    order = phase_order(new.columns, key)
    fresh = new.withColumn("_old_stamp", F.lit(None).cast(new.schema["processed_at"].dataType))

    def lagged(rows: DataFrame, before: DataFrame | None) -> DataFrame:
        """``before`` (key, last) holds the rows that stand before the first of ``rows``; they are left out again."""
        marked = rows.withColumn("_before", F.lit(False))
        if before is not None:
            ghosts = before.select(key, "last.*").withColumn("_before", F.lit(True))
            marked = marked.unionByName(ghosts, allowMissingColumns=True)
        out = lag_by_key(marked, [key], order, altitude_col, "prev_alt", hot_rows).where(~F.col("_before")).drop("_before")
        return out.withColumn("flight_phase", flight_phase_expr(altitude_col, "prev_alt", delta))

    if state is None:
        return PhaseUpdate(lagged(fresh, None), set())
    seen = Observation("late-aircraft")
    starts = edges.groupBy(F.col(key).alias("_k")).agg(F.min("first").alias("_first"))
    late = F.col("_first") <= F.col("last")
    known = materialize(starts.join(state, F.col("_k").eqNullSafe(F.col(key))).select(key, "last", late.alias("late"))
                        .observe(seen, F.count_if("late").alias("late")), "phase-known")
    before = known.where(~F.col("late")).select(key, "last")
    if not seen.get["late"]:
        return PhaseUpdate(lagged(fresh, before), set())

    behind = known.where("late").select(F.col(key).alias("_k"))
    chain = old_edges.withColumn("is_new", F.lit(False)).unionByName(edges.withColumn("is_new", F.lit(True)))
    days = (chain.join(behind, F.col(key).eqNullSafe(F.col("_k")), "left_semi").groupBy(key, DAY)
            .agg(F.max("last").alias("last"), F.max("is_new").alias("has_new"), F.max(~F.col("is_new")).alias("has_old")))
    own = Window.partitionBy(key).orderBy(F.col(DAY).asc_nulls_first())
    days = days.withColumn("touched", F.col("has_new") | F.coalesce(F.lag("has_new").over(own), F.lit(False)))
    days = days.select(key, DAY, "touched", "has_old", F.lag("last").over(own).alias("prev_last"),
                       F.coalesce(F.lag("touched").over(own), F.lit(False)).alias("prev_touched"))
    pairs = materialize(days.where("touched").drop("touched"), "phase-days")
    rewritten = days_of(pairs.where("has_old"))
    carried = pairs.where(F.col("prev_last").isNotNull() & ~F.col("prev_touched")).select(key, F.col("prev_last").alias("last"))
    before = before.unionByName(carried)
    stored = stored_days(rewritten)
    again = pairs.where("has_old").select(F.col(key).alias("_k"), F.col(DAY).alias("_d"))
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col(DAY).eqNullSafe(F.col("_d"))
    reopened = stored.join(again, same, "left_semi").select(*new.columns)
    rows = lagged(fresh.unionByName(reopened, allowMissingColumns=True), before)
    kept = stored.join(again, same, "left_anti").withColumn("_old_stamp", F.col("processed_at"))
    return PhaseUpdate(rows.unionByName(kept), rewritten)
