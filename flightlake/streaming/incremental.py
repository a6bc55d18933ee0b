"""Incremental silver (J1) and cross-run key uniqueness.

The source pipeline re-reads every landed file each hour and appends, so keys repeat across runs. Here a file
stream picks up only new files (the checkpoint remembers which were read) and the row-wise silver cleaning runs
unchanged.

``run_exact_available_now`` is the pipeline's path: each micro-batch is appended through the keyed append of the
silver table. A row is stored exactly if its key is not stored yet, however late it arrives; the survivor is
deterministic (the smallest row of a key within the batch; the first batch that holds a key wins), and a replayed
batch adds nothing, so the at-least-once batch sink is exactly-once on the table.

``dedupe_stream`` is the bounded operator (``dropDuplicatesWithinWatermark``): a key is remembered until event time
passes it by the delay, so state stays small, and **rows that arrive later than the delay are dropped, new keys
too**. It suits streams whose lateness is known to be bounded; no pipeline of this library uses it.
``trigger(availableNow=True)`` processes what is there and stops, so the same code runs as an hourly batch or
continuously.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flightlake import schemas
from flightlake.operators.silver import SILVER_KEYS, silver_rows
from flightlake.session import scratch_scope
from flightlake.sources.silver_table import append_silver

# A century: no landed file is too old to be read.
MAX_FILE_AGE = "36500d"


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """J2, bounded: drop rows whose key was seen within the watermark delay, and rows later than the delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def landed_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed snapshot files as a stream of documents, each file once, whatever its time stamp says.

    A file stream passes over files that are ``maxFileAge`` (a week, unless set) older than the newest it has seen, so a file
    copied in with its old time stamp, or left over from a long stop, would be lost; the age is set beyond any such file.
    """
    reader = spark.readStream.schema(schemas.RAW_SNAPSHOT).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(raw_dir)


def silver_rows_stream(spark: SparkSession, raw_dir: str, run_ts: Column | None = None, time_index: int = 4,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed snapshot files as a stream of cleaned silver rows (no key de-duplication yet)."""
    return silver_rows(landed_stream(spark, raw_dir, max_files_per_trigger), run_ts, time_index)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      timeout_s: float | None = None) -> StreamingQuery:
    """Process every file available now into ``sink_path`` (append), then stop.

    The file sink keeps its own log in ``sink_path``; Spark then reads only files of that log there, so nothing else
    may write to the folder.
    """
    query = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(timeout_s)
    return query


def append_silver_batches(sink_path: str, keys: Sequence[str] = SILVER_KEYS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends only keys not yet stored at ``sink_path`` (C6 per batch)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            append_silver(batch, sink_path, keys)

    return write


def run_exact_available_now(stream: DataFrame, sink_path: str, checkpoint: str,
                            keys: Sequence[str] = SILVER_KEYS, timeout_s: float | None = None) -> StreamingQuery:
    """Process every file available now; each micro-batch is appended exactly (see module notes)."""
    query = (
        stream.writeStream.foreachBatch(append_silver_batches(sink_path, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(timeout_s)
    return query
