"""Scans: landed JSON snapshots, parquet layers with file filters, and file lineage."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightlake import schemas
from flightlake.fixed import STATE_FIELDS
from flightlake.functions.columns import safe_cast, state_field


def read_snapshots(spark: SparkSession, path: str | list[str], corrupt_col: str | None = None,
                   multi_line: bool = False) -> DataFrame:
    """A1: landed snapshot documents ``{"time": .., "states": [[..], ..]}`` with a fixed schema.

    No inference pass. Documents that do not parse keep NULL fields; with ``corrupt_col`` their raw
    text is kept in that column. Mixed number/boolean/text values inside a state arrive as text.
    ``multi_line`` reads files that hold one (pretty-printed) document each; such a file is one task,
    while line-delimited files are split across tasks.
    """
    schema = schemas.RAW_SNAPSHOT
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", str(multi_line).lower())
    if corrupt_col:
        schema = StructType([*schema.fields, StructField(corrupt_col, StringType())])  # ``add`` would change the shared schema
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).json(path)


def read_layer(
    spark: SparkSession,
    *paths: str,
    glob: str | None = None,
    merge_schema: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Parquet scan of one or more folders.

    ``glob`` keeps only matching file names (``pathGlobFilter``); files starting with ``_`` or ``.``
    (``_SUCCESS``, checksums) are skipped by Spark itself. Several folders of one schema are read as one scan;
    with ``merge_schema`` they may be tables of their own, partitioned or not: each is read from its own base folder
    and the rows are put together by column name.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if not merge_schema:
        return reader.parquet(*paths)
    frames = [reader.parquet(path) for path in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_tables(spark: SparkSession, paths: Mapping[str, str], name: str = "source_table") -> DataFrame:
    """Several tables (name -> folder) as one frame, each row tagged with its table's name."""
    frames = [read_layer(spark, path, merge_schema=True).withColumn(name, F.lit(table)) for table, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_stored(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The parquet table at ``path``, or None when nothing has been written there yet (no folder, or one without data
    files). Any other failure is raised: an unreadable table must not be taken for a new one.

    With a known ``schema`` there is no footer-inference job (and an empty folder reads as empty).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def with_source_file(df: DataFrame, name: str = "source_file", full_path: bool = False) -> DataFrame:
    """Keep the file each row came from (hidden ``_metadata`` column of file sources)."""
    field = "_metadata.file_path" if full_path else "_metadata.file_name"
    return df.withColumn(name, F.col(field))


def with_source_folder(df: DataFrame, name: str = "source_table") -> DataFrame:
    """The table folder each row of a single scan was read from; partition folders (``key=value``) are
    passed over."""
    folders = F.filter(F.split(F.col("_metadata.file_path"), "/"), lambda part: ~part.contains("="))
    return df.withColumn(name, F.element_at(folders, -2))


def snapshot_states(raw: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per state array. ``keep_empty`` keeps a NULL row for NULL/empty ``states``."""
    gen = F.explode_outer("states") if keep_empty else F.explode("states")
    return raw.select(F.col("time").alias("snapshot_time"), gen.alias("s"))


def bronze_from_snapshots(raw: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Snapshots -> the 17 typed bronze columns plus the snapshot ``time``.

    Positions are read with ``F.get`` (short arrays give NULL) and cast with ``try_cast`` (text that
    does not parse gives NULL). Every landed state becomes a row; there is no ingestion cap.
    """
    states = snapshot_states(raw, keep_empty)
    typed = [
        safe_cast(state_field("s", i), kind).alias(name) if kind != "string" else state_field("s", i).alias(name)
        for i, (name, kind) in enumerate(STATE_FIELDS)
    ]
    return states.select("snapshot_time", *typed)
