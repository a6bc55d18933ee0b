"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Settings every job relies on. AQE re-plans joins and partition counts at runtime and splits
# skewed shuffle partitions; the session zone is pinned so epoch <-> text conversions are stable.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Streaming de-duplication state lives in RocksDB (off-heap, spills to local disk, checkpointed
    # incrementally to the shared checkpoint folder) instead of executor heap maps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The library's streams emit rows as they arrive (de-duplication, no windowed aggregates), so an
    # empty micro-batch at the end of each availableNow trigger would only evict expired state early;
    # the next run's first batch evicts it anyway.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "flightlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's defaults; ``master`` only for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to a shared file system every executor sees; an unset
    value is an error there. Only a local-mode session (tests, notebooks) without the setting gets a
    fresh folder created here and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="flightlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


# Open ``scratch_scope`` blocks of this thread, innermost last; each collects the folders named inside it.
_OPEN = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """The name of a fresh, unique sub-folder of the checkpoint root for one job's written intermediates.

    Only the name is made here; the writer that uses it creates the folder, on the file system of the root.
    """
    root = checkpoint_root(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    scopes = getattr(_OPEN, "scopes", [])
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediates written inside the block when it ends (success or failure).

    For whole jobs (e.g. the hourly gold run) whose outputs are final tables: the per-run summaries
    and hot-row copies in the shared folder are not needed afterwards, so they do not pile up run
    after run. Only folders created by ``scratch_path`` inside this block are removed (through the
    Hadoop file system of the path, so it works on any shared store). Frames returned out of the
    block must not read them lazily afterwards.
    """
    created: list[str] = []
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scopes.append(created)
    try:
        yield created
    finally:
        scopes.pop()
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in created:
            jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(conf).delete(jpath, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared checkpoint folder and return a frame reading it (lineage cut).

    For derived tables (grouped sums, per-group summaries, key sets) that several later steps or
    driver-side bounded checks read: they are computed exactly once from the big input, survive
    executor loss, and the reader knows their real size (file statistics), so the planner sizes
    joins against them from facts. Never ``localCheckpoint``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``materialize`` plus the exact row count, observed while the table is written (no extra job).

    The count is a proven size bound for a later broadcast of the written table.
    """
    seen = Observation(f"rows-{name}")
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return written, int(seen.get["rows"])
