"""WARC archives of pages and an external merge of their capture index.

Writing: each page is a WARC/1.1 record; of equal payloads the first is a response and the others are revisit
records that point to it. Files come from Spark's own text writer (a record is a value, the blank line that ends it
is the line separator), so they are whole, retried and visible to every executor.

Index: each archive read back gives one run of captures, sorted in its task by URL key, time and id, and written as
sorted blocks. Range bounds come from the blocks' first keys; blocks are cut at them, so a range holds sorted segments
of k runs, and a task merges the segments of a range with a loser tree, decoding them block by block. No row is sorted
a second time. Ranges in order, positions in order: globally ordered capture histories (a URL with very many captures is split by time
and id).
"""

from __future__ import annotations

import gzip
import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from flightlake.llm.common import map_arrow
from flightlake.session import materialize, materialize_counted, scratch_path

MIN_PAYLOAD = 100
# Greatest bytes of an archive (a larger record has one to itself), index rows per range and per block of a run, and duplicate
# digests that may be broadcast.
FILE_BYTES, MERGE_ROWS, BLOCK_ROWS, BROADCAST_DIGESTS = 16 * 1024 * 1024, 100_000, 2_000, 200_000
# Without a date column a capture's time is this plus its id in seconds, modulo 100,000 days.
EPOCH, SPAN = "2024-01-01 00:00:00", 100_000 * 86_400
# Bytes of a record's header that is usual, counted with its payload; least size class (4^k bytes).
HEADER_BYTES, LEAST_CLASS = 600, 6
_END = "\r\n\r\n"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host names reversed, no ``www.``, port 80/443, fragment or scheme; host in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = parts.port
    except ValueError:
        return url
    names = ",".join(reversed(host.split("."))) if host else ""
    mark = f":{port}" if port and port not in (80, 443) else ""
    return f"{names}{mark}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def _roles(pages: DataFrame) -> DataFrame:
    """``pages`` (id, url, payload, at) with size, digest and ``first``: the response's id where payloads repeat.

    Digest, size and id are written once, as a narrow table, and the repeated payloads found in that.
    """
    sized = pages.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    narrow = materialize(sized.where(F.col("size") >= MIN_PAYLOAD).select("digest", "id"), "payload-digests")
    repeated = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeated, n = materialize_counted(repeated, "repeated-payloads")
    return sized.join(F.broadcast(repeated) if n <= BROADCAST_DIGESTS else repeated, "digest", "left")


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date_col: str | None = None) -> str:
    """Write one record per row to a fresh shared folder and return its path.

    The payload is the text in UTF-8 (null: empty). Of rows with equal payloads of ``MIN_PAYLOAD`` bytes or more, that
    with the smallest id is a response, the others are revisits without a body of their own; a null id is never the
    smallest. Ids keep their type (whole numbers, or anything that casts to text). Without ``date_col`` a capture's time is a fixed day plus its
    id (of text: its CRC) in seconds, modulo ``SPAN``.

    An archive holds records of one size class (powers of 4) from so many rows in a row of a task that it has at most
    ``FILE_BYTES``, wherever the large ones lie; only a larger record has an archive to itself.
    """
    whole = isinstance(pages.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    own_id = F.col(id_col).cast("long" if whole else "string")
    tick = F.pmod(F.coalesce(own_id, F.lit(0)), F.lit(SPAN)) if whole else F.crc32(F.coalesce(own_id, F.lit("")).cast("binary"))
    stamp = F.col(date_col).cast("timestamp") if date_col else F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH).cast("timestamp")) + tick)
    rows = pages.select(own_id.alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"), stamp.alias("at"))
    known = _roles(rows)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def urn(c: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.url_encode(F.col(c).cast("string")), F.lit(">"))

    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", urn("id")),
        _header("WARC-Target-URI", url),
        _header("WARC-Date", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("X-Payload-Length", F.col("size").cast("string")),
        _header("WARC-Refers-To", F.when(revisit, urn("first"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string")), F.lit(_END))
    bytes_ = F.when(revisit, F.lit(0)).otherwise(F.col("size")) + F.lit(HEADER_BYTES) + F.coalesce(F.octet_length("url"), F.lit(0))
    kind = F.greatest(F.lit(LEAST_CLASS), F.ceil(F.log2(bytes_.cast("double")) / 2)).cast("int")
    per_file = F.greatest(F.lit(1.0), F.floor(F.lit(float(FILE_BYTES)) / F.pow(F.lit(4.0), F.col("size_class"))))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's number in its task
    records = (known.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value"), kind.alias("size_class"), row.alias("row"))
               .withColumn("block", F.floor(F.col("row") / per_file).cast("long")).drop("row"))
    path = scratch_path(pages.sparkSession, "warc")
    records.write.option("lineSep", _END).option("compression", "gzip").partitionBy("size_class", "block").mode("overwrite").text(path)
    return path


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers with lower-case names, payload) of each record of an uncompressed archive."""
    at, end = 0, _END.encode()
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head_end = data.index(end, at)
        lines = data[at:head_end].decode("utf-8").split("\r\n")
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
        start, size = head_end + 4, int(headers["content-length"])
        if data[start + size:start + size + 4] != end:
            raise ValueError(f"record at byte {at} is cut short")
        yield at, headers, data[start:start + size]
        at = start + size + 4


def index_schema(id_type: T.DataType) -> T.StructType:
    """Columns of the capture index; ``run`` is the archive, ``offset`` the record's place in it (uncompressed)."""
    text, number = T.StringType(), T.LongType()
    kinds = {"url_key": text, "captured_at": text, "page_id": id_type, "payload_bytes": number, "payload_digest": text, "record_type": text,
             "refers_to": id_type, "run": text, "offset": number}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in schema])


def _named(urn: str | None, whole: bool) -> int | str | None:
    text = unquote(urn[len("<urn:page:"):-1].replace("+", " ")) if urn else None
    return int(text) if text is not None and whole else text


def _sort_key(row) -> tuple:
    """Order of captures: URL key, time, id (null first), archive, place."""
    key, at, page, run, offset = row
    return key, at, page is not None, 0 if page is None else page, run, offset


_KEYS = ["url_key", "captured_at", "page_id", "run", "offset"]


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _keys_of(table: pa.Table) -> list[tuple]:
    """The sort keys of a block, with those of one id type comparable."""
    return [_sort_key(row) for row in zip(*[table.column(c).to_pylist() for c in _KEYS])]


def capture_runs(spark, path: str, id_type: T.DataType = T.LongType()) -> DataFrame:
    """Sorted blocks of all archives under ``path``: ``run``, ``block``, ``n`` rows, first key, and the rows (Arrow)."""
    schema = _arrow(index_schema(id_type))
    whole = not isinstance(id_type, T.StringType)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                run, rows = "/".join(name.split("/")[-3:]), []
                for offset, head, payload in records(gzip.decompress(content.as_py())):
                    kind, digest = head["warc-type"], head["warc-payload-digest"].partition(":")[2]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{run}: payload at byte {offset} does not have its digest")
                    size = len(payload) if kind == "response" else int(head["x-payload-length"])
                    rows.append((url_key(head.get("warc-target-uri")), head.get("warc-date") or "", _named(head.get("warc-record-id"), whole),
                                 size, digest, kind, _named(head.get("warc-refers-to"), whole), run, offset))
                rows.sort(key=lambda r: _sort_key((r[0], r[1], r[2], r[7], r[8])))
                for block, start in enumerate(range(0, len(rows), BLOCK_ROWS)):
                    part = rows[start:start + BLOCK_ROWS]
                    table = pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*part), schema.types)], schema=schema)
                    first = part[0]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([run]), pa.array([block], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([first[0]]), pa.array([first[1]]),
                        pa.array([first[2]], schema.field("page_id").type), pa.array([first[8]], pa.int64()), pa.array([_packed(table)], pa.binary())],
                        names=["run", "block", "n", "url_key", "captured_at", "page_id", "offset", "rows"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    kind = "string" if isinstance(id_type, T.StringType) else "long"
    return map_arrow(files, index, f"run string, block int, n long, url_key string, captured_at string, page_id {kind}, offset long, rows binary")


class LoserTree:
    """k-way merge: ``next()`` gives (run, key) of the least head; one path of log2(k) matches is replayed for each."""

    def __init__(self, runs: list[Iterator]) -> None:
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._replay(run, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x < y or (x == y and a < b)))

    def _replay(self, run: int, building: bool = False) -> None:
        node = (run + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0 and building:
                self.losers[node] = run
                return
            if other >= 0 and self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        while self.k and self.heads[self.losers[0]] is not None:
            run = self.losers[0]
            yield run, self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self._replay(run)


def _segment(blocks: list[tuple[int, pa.Table]]) -> Iterator[tuple[tuple, int, int]]:
    """The keys of a run's blocks in order, with the number of the block and the row in it; a block's keys are laid out only
    when the merge has come to it."""
    for number, block in blocks:
        for i, key in enumerate(_keys_of(block)):
            yield key, number, i


def merge_runs(runs: DataFrame, n: int, id_type: T.DataType = T.LongType()) -> DataFrame:
    """Globally ordered captures from sorted, written blocks of runs (``n`` rows in all): by ``range_no``, then ``position``.

    Bounds are the least keys of a range partitioning of the blocks' first keys (one for each range, so about one for
    ``MERGE_ROWS`` rows); a range of few blocks of every run holds more or fewer rows than that, never a whole hot URL.
    """
    spark = runs.sparkSession
    schema = index_schema(id_type)
    arrow = _arrow(schema)
    ranges = max(1, math.ceil(n / MERGE_ROWS), min(n // BLOCK_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    firsts = runs.select(*_KEYS).repartitionByRange(ranges, *_KEYS).withColumn("part", F.spark_partition_id())
    least = firsts.groupBy("part").agg(F.min(F.struct(*_KEYS)).alias("key")).collect()
    bounds = sorted(_sort_key(tuple(r["key"])) for r in least)[1:]
    shared = spark.sparkContext.broadcast(bounds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, block, data in zip(*[batch.column(c).to_pylist() for c in ("run", "block", "rows")]):
                table = _unpacked(data)
                keys = _keys_of(table)
                places = [0, *[bisect_left(keys, b) for b in shared.value], len(keys)]
                for number, (a, b) in enumerate(zip(places, places[1:])):
                    if a < b:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([number], pa.int32()), pa.array([run]), pa.array([block], pa.int32()),
                            pa.array([data if b - a == len(keys) else _packed(table.slice(a, b - a))], pa.binary())],
                            names=["range_no", "run", "block", "rows"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in ("range_no", "run", "block", "rows")]))
        for number, own in groupby(segments, key=lambda r: r[0]):
            tables, by_run = [], {}
            for _, run, _, data in own:
                by_run.setdefault(run, []).append((len(tables), _unpacked(data)))
                tables.append(by_run[run][-1][1])
            starts, total = [], 0
            for table in tables:
                starts.append(total)
                total += len(table)
            whole = pa.concat_tables(tables)
            order = [starts[block] + i for _, (_, block, i) in LoserTree([_segment(by_run[run]) for run in sorted(by_run)])]
            for a in range(0, total, 20_000):
                part = whole.take(pa.array(order[a:a + 20_000], pa.int64())).combine_chunks()
                part = part.append_column("range_no", pa.array([number] * len(part), pa.int32()))
                yield from part.append_column("position", pa.array(range(a, a + len(part)), pa.int64())).to_batches()

    cuts = map_arrow(runs.select("run", "block", "rows"), cut, "range_no int, run string, block int, rows binary")
    dealt = cuts.repartition(ranges, "range_no").sortWithinPartitions("range_no", "run", "block")  # segments in order; rows stay as they lie
    out = T.StructType([*schema.fields, T.StructField("range_no", T.IntegerType()), T.StructField("position", T.LongType())])
    return map_arrow(dealt, merge, out)


def archive_and_index(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      date_col: str | None = None) -> DataFrame:
    """Write archives, read them back and merge their index: one row per page row.

    Columns of the index, ``range_no`` and ``position``. Repeated rows have records of their own (all rows with the
    smallest id of a payload are responses, and rows of one id share a record id); null urls sort first, null ids before others; an empty
    table gives no rows; other columns are not read.
    """
    whole = isinstance(pages.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    id_type = T.LongType() if whole else T.StringType()
    path = write_archives(pages, id_col, url_col, html_col, date_col)
    runs = materialize(capture_runs(pages.sparkSession, path, id_type), "capture-runs")
    n = runs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return merge_runs(runs, n, id_type)
