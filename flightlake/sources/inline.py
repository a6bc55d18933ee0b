"""Small literal tables (A2, A3, A4): reference dimensions created from Python rows."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from flightlake import schemas
from flightlake.fixed import AIRPORTS, INLINE_CITIES


def rows_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """Rows -> DataFrame with an explicit schema (DDL string or StructType); no inference pass.

    One typing rule for any number of rows: values are put into Arrow columns of the schema's types (an integer is a
    valid DOUBLE, text is never parsed). Spark plans such a table as a local relation of known size, so joins
    against a small one broadcast without a runtime check.
    """
    rows = list(rows)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = to_arrow_schema(schema, timestamp_utc=True)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, schema=fields), schema=schema)


def airports_frame(spark: SparkSession, rows: Iterable[tuple] = AIRPORTS) -> DataFrame:
    """Reference airports ``(code, lat_ref, lon_ref, airport_name)``; pass your own rows to extend."""
    return rows_frame(spark, rows, schemas.AIRPORTS)


def cities_frame(spark: SparkSession, rows: Iterable[tuple] = INLINE_CITIES) -> DataFrame:
    """The report's inline city table ``(Lat, Lon, City)``."""
    return rows_frame(spark, rows, schemas.CITIES)
