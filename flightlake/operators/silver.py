"""Silver cleaning (L1): positional projection, null filter, trim, safe casts, time text, dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.fixed import LEGACY_RENAMES, REPORT_CLEANED_TYPES, SILVER_DOUBLE_COLUMNS, SILVER_POSITIONS
from flightlake.functions.columns import epoch_to_text, safe_cast, state_field
from flightlake.operators.dedupe import keep_first

SILVER_KEYS = ["icao24", "time_position"]


# Cells of a row whose text did not convert, and the file they came from.
RESCUED = "_rescued"
RESCUED_TYPE = "array<struct<column_name:string,raw_text:string>>"


def project_states(states: DataFrame, time_index: int = 4, states_col: str = "s", keep: Sequence[str] = ()) -> DataFrame:
    """B1: read the kept positions of each state array under their silver names (all text).

    ``time_index`` chooses the array position published as ``time_position`` (4 by default, as the
    source job does; 3 is the field's true position). Columns in ``keep`` stay beside them.
    """
    cols = []
    for pos, name in SILVER_POSITIONS:
        if name == "time_position":
            pos = time_index
        cols.append(state_field(states_col, pos).alias(name))
    return states.select(*cols, *keep)


def clean_states(
    projected: DataFrame,
    run_ts: Column | None = None,
    drop_blank: bool = False,
    drop_null_coords: bool = False,
) -> DataFrame:
    """B8, I1, I3, I4, I5 (+ optional B9): the row-wise part of silver, no shuffle.

    The NULL filter runs before the trim, so blank callsigns survive as ``""`` unless ``drop_blank``.
    """
    out = projected.filter(F.col("callsign").isNotNull())
    casts = {"callsign": F.trim(F.col("callsign"))}
    casts.update({c: safe_cast(c, "double") for c in SILVER_DOUBLE_COLUMNS})
    casts["flight_time"] = epoch_to_text("time_position")
    casts["processed_at"] = run_ts if run_ts is not None else F.current_timestamp()
    out = out.withColumns(casts)
    if drop_blank:
        out = out.filter(F.col("callsign") != F.lit(""))
    if drop_null_coords:
        out = out.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return out


def to_silver(
    raw: DataFrame,
    run_ts: Column | None = None,
    time_index: int = 4,
    drop_blank: bool = False,
    drop_null_coords: bool = False,
) -> DataFrame:
    """L1: snapshot documents -> silver rows, unique on (icao24, time_position).

    The surviving row of a duplicated key is the smallest by the remaining columns (deterministic);
    the de-duplication combines copies map-side first (see ``keep_first``).
    """
    return keep_first(silver_rows(raw, run_ts, time_index, drop_blank, drop_null_coords), SILVER_KEYS)


def silver_rows(
    raw: DataFrame,
    run_ts: Column | None = None,
    time_index: int = 4,
    drop_blank: bool = False,
    drop_null_coords: bool = False,
) -> DataFrame:
    """The row-wise part of L1 (explode, positions, filters, casts), before the key de-duplication."""
    states = raw.select(F.explode("states").alias("s"))
    return clean_states(project_states(states, time_index), run_ts, drop_blank, drop_null_coords)


def legacy_to_current(df: DataFrame) -> DataFrame:
    """Q14: the report's older silver schema (``long``/``lat``) under the current names."""
    for old, new in LEGACY_RENAMES.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def declared_types(df: DataFrame, types=REPORT_CLEANED_TYPES) -> DataFrame:
    """The report's cast list, as ``try_cast`` (its "error values as null" option), in its order.

    A declared column missing from ``df`` is a NULL column of its type, so the result always has the declared
    columns; columns not in the list are dropped (the report keeps only its declared columns).
    """
    present = set(df.columns)
    return df.select(*[(safe_cast(c, kind) if c in present else F.lit(None).cast(kind)).alias(c) for c, kind in types])


def report_silver(df: DataFrame, types=REPORT_CLEANED_TYPES) -> DataFrame:
    """The report's read of the older silver layout, under the current column names."""
    return legacy_to_current(declared_types(df, types))


def rescuing_rows(raw: DataFrame, run_ts: Column | None = None, time_index: int = 4, source: Column | None = None) -> DataFrame:
    """``silver_rows`` and, per row, its cells that did not convert (``_rescued``) and the file it came from (``source_file``).

    One pass makes both: the silver columns are those of ``silver_rows``, and ``_rescued`` holds the column and raw text of
    each cell that a cast turned into NULL (a NULL or missing cell is none). ``source`` names the file of a row
    (``F.col("_metadata.file_name")`` on a file scan).
    """
    file = source if source is not None else F.lit(None).cast("string")
    states = raw.select(F.explode("states").alias("s"), file.alias("source_file"))
    rows = project_states(states, time_index, keep=["source_file"])
    failed = [F.when(F.col(c).isNotNull() & safe_cast(c, "double").isNull(), F.struct(
        F.lit(c).alias("column_name"), F.col(c).alias("raw_text"))) for c in SILVER_DOUBLE_COLUMNS]
    found = F.filter(F.array(*failed), lambda cell: cell.isNotNull()).cast(RESCUED_TYPE)
    return clean_states(rows.withColumn(RESCUED, found), run_ts)


def rescued_cells(rows: DataFrame) -> DataFrame:
    """The side table: one row per cell that did not convert, with its row's keys, raw text and file."""
    return rows.select(*SILVER_KEYS, "source_file", "processed_at", F.inline(RESCUED))


def sensor_values(df: DataFrame, text_col: str = "sensors") -> DataFrame:
    """The untyped ``sensors`` cell as a typed value, beside its text.

    The field may hold anything, so its text is parsed as VARIANT: ``sensors_type`` is the type found (NULL for text that
    is no JSON), ``sensor_ids`` the whole numbers of an array of them or of a single one, else NULL.
    """
    value = F.try_parse_json(F.col(text_col))
    one = F.try_variant_get(value, "$", "bigint")
    is_number = F.schema_of_variant(value).isin("BIGINT")
    return (df.withColumn("sensors_type", F.schema_of_variant(value))
            .withColumn("sensor_ids", F.when(is_number, F.array(one)).otherwise(F.try_variant_get(value, "$", "array<bigint>"))))
