"""Tables committed together: readers see what the newest manifest of a folder lists, and nothing else.

Under ``base`` every table has a folder, every run writes into new folders of its own
(``<table>/run=<name>/flight_date=<day>``), and no written file is ever changed. A run becomes visible as a whole when its manifest, a small
JSON file naming the live folders of all tables, is renamed into place at the very end. A run that dies before that leaves
the earlier one as it was, and its folders are written over by the next try. One job writes to a base at a time; a second one
that commits the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from flightlake.sources.sinks import write_overwrite

MANIFESTS = "_manifests"
RUN = "run"
DAY = "flight_date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """A folder of one table: its place under the table, the commit that added it, its files and bytes.

    ``appended`` parts hold new rows; others hold rows that earlier parts had (a rewrite).
    """

    place: str
    seq: int
    files: int
    size: int
    appended: bool = True

    @property
    def day(self) -> str | None:
        """The day of the partition, ``NO_DAY`` for rows without one, None for a table without days."""
        last = self.place.rsplit("/", 1)[-1]
        return last.split("=", 1)[1] if last.startswith(f"{DAY}=") else None


@dataclass
class Version:
    """What a manifest holds. Number 0 is the empty table."""

    seq: int = 0
    parts: dict[str, list[Part]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _manifest_path(base: str, seq: int) -> str:
    return f"{base.rstrip('/')}/{MANIFESTS}/{seq:012d}.json"


def current(spark: SparkSession, base: str) -> Version:
    """The newest committed version (the empty one before the first commit)."""
    fs, folder = _fs(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return Version()
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    return read_version(spark, base, max(numbers)) if numbers else Version()


def read_version(spark: SparkSession, base: str, seq: int) -> Version:
    text = "\n".join(r["value"] for r in spark.read.text(_manifest_path(base, seq), wholetext=True).collect())
    held = json.loads(text)
    return Version(held["seq"], {t: [Part(**p) for p in parts] for t, parts in held["parts"].items()}, held["schemas"], held["facts"])


def commit(spark: SparkSession, base: str, version: Version) -> Version:
    """Make ``version`` the visible one: written aside, then renamed to its number."""
    fs, target = _fs(spark, _manifest_path(base, version.seq))
    if fs.exists(target):
        raise RuntimeError(f"version {version.seq} of {base} was committed by another run")
    _, aside = _fs(spark, f"{base.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}")
    text = json.dumps({"seq": version.seq, "schemas": version.schemas, "facts": version.facts, "parts": {
        t: [vars(p) for p in parts] for t, parts in version.parts.items()}})
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(aside, target):
        raise RuntimeError(f"version {version.seq} of {base} could not be committed")
    return version


def write_parts(df: DataFrame, base: str, table: str, run: str, seq: int, by_day: bool = True, appended: bool = True) -> list[Part]:
    """Write ``df`` into the run's own folder of ``table`` and return its parts (not visible before a commit).

    Rows are dealt out by day, a day of much more than the advisory partition size to several tasks, so a day gets a file
    for each such size and not one for every task that held its rows.
    """
    folder = f"{base.rstrip('/')}/{table}/{RUN}={run}"
    if by_day:
        write_overwrite(df.hint("rebalance", DAY), folder, [DAY])
    else:
        write_overwrite(df, folder)
    spark = df.sparkSession
    fs, root = _fs(spark, folder)
    sizes: dict[str, list[int]] = {}
    found = fs.listFiles(root, True)
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            parent = status.getPath().getParent().getName()
            place = f"{RUN}={run}/{parent}" if by_day else f"{RUN}={run}"
            sizes.setdefault(place, []).append(status.getLen())
    return [Part(place, seq, len(s), sum(s), appended) for place, s in sorted(sizes.items())]


def read_parts(spark: SparkSession, base: str, table: str, parts: Iterable[Part], schema: StructType) -> DataFrame:
    """The rows of some parts as one scan (the day is a partition column); no parts: no rows."""
    root = f"{base.rstrip('/')}/{table}"
    places = [f"{root}/{p.place}" for p in parts]
    if not places:
        return spark.createDataFrame([], schema)
    frame = spark.read.schema(schema).option("basePath", root).parquet(*places)
    return frame.select(*[f"`{c}`" for c in schema.names])


def read_table(spark: SparkSession, base: str, table: str, version: Version | None = None) -> DataFrame:
    """The committed rows of a table (all runs), or those of an earlier ``version``."""
    version = version or current(spark, base)
    if table not in version.schemas:
        raise ValueError(f"{base} has no committed table {table}")
    return read_parts(spark, base, table, version.parts[table], StructType.fromJson(json.loads(version.schemas[table])))


def expire(spark: SparkSession, base: str, keep: int = 1) -> int:
    """Delete what none of the newest ``keep`` versions lists: older manifests, then folders; returns how many folders went.

    Folders go that an older version replaced or that a run left which died, but none of a run that is still to be committed.
    The kept versions stay whole. Run it when no reader is on an older one.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    newest = current(spark, base).seq
    fs, folder = _fs(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    if not newest:
        return 0
    numbers = sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if s.getPath().getName()[:-5].isdigit())
    live: dict[str, set[str]] = {}
    for seq in numbers[-keep:]:
        for table, parts in read_version(spark, base, seq).parts.items():
            live.setdefault(table, set()).update(p.place for p in parts)
    for seq in numbers[:-keep]:
        fs.delete(_fs(spark, _manifest_path(base, seq))[1], False)
    gone = 0
    for table in fs.listStatus(_fs(spark, base)[1]):
        if not table.isDirectory() or table.getPath().getName().startswith(("_", ".")):
            continue
        held = live.get(table.getPath().getName(), set())
        for run in fs.listStatus(table.getPath()):
            name = run.getPath().getName()
            number = name.rsplit("-", 1)[-1]
            if not name.startswith(f"{RUN}=") or not number.isdigit() or int(number) > newest or name in held:
                continue
            days = [s.getPath() for s in fs.listStatus(run.getPath()) if s.getPath().getName().startswith(f"{DAY}=")]
            dead = [p for p in days if f"{name}/{p.getName()}" not in held]
            for path in [run.getPath()] if len(dead) == len(days) else dead:
                fs.delete(path, True)
            gone += len(dead) if days else 1
    return gone


def days_of(df: DataFrame) -> set[str]:
    """The days of some rows, as partition names (at most the days of the calendar)."""
    return {str(r[DAY]) if r[DAY] is not None else NO_DAY for r in df.select(DAY).distinct().collect()}


def of_days(parts: Iterable[Part], days: set[str]) -> list[Part]:
    return [p for p in parts if p.day in days]
