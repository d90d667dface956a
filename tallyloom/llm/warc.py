"""WARC archives of web captures, and their global index by an external merge.

Writing: captures with equal payloads (by SHA-256, of at least ``MIN_REVISIT`` bytes) become one
response and revisits that refer to it. Records are assembled by Spark and written by its text writer, whose
line separator is the record's closing blank lines, into gzip archives of a bounded number of records.

Reading: each archive is decompressed as a stream and parsed by Content-Length, one record at a time.

Index merge: the entries of each reading task are sorted into a run and cut into blocks at the borders of key
ranges. A range's blocks reach one task in the order of their first keys; a loser tree merges the runs and
holds one open block per run, so memory depends on the number of runs and not on their length. The result is
one order over all captures by (URL key, time, key), with gapless positions.

Defined results: null payload is empty; null url gives no target and the empty URL key, which sorts first; a
null key is written as ``none``, never becomes the response of others while a keyed capture has the payload,
and sorts last; rows with the same smallest key and payload are all responses. Line breaks in a url are
percent-encoded. Payloads of any length that a string holds are written whole, large ones in archives of fewer records.
Columns besides the four named are not read. An empty table gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import scratch_path, small_batches, stored, text_or_empty

MIN_REVISIT = 100
RECORDS_PER_ARCHIVE = 20_000
#: Largest payload bytes of a size class: an archive holds RECORDS_PER_ARCHIVE of the smallest class, and of a larger one so
#: many fewer that it stays below the 2 GB that a row of ``binaryFile`` can have.
SIZE_CLASSES = (1 << 16, 1 << 20, 1 << 24)
BLOCK_ENTRIES = 1024
RANGE_ENTRIES = 100_000
MAX_RANGES = 4096  # more entries make longer ranges; a range is merged as a stream
END = "\r\n\r\n"
ID = "urn:capture:"

ENTRY = (
    "url_key string, captured_at string, key long, record_type string, url string, payload_bytes long, "
    "payload_digest string, refers_to long, archive string, offset long, length long"
)


def url_key(url: Column) -> Column:
    """Sort-friendly form: host names reversed, then the rest: com,example,www)/path?query."""
    rest = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^([^/?#:]*)", 1)
    return F.when(url.isNull(), "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, r"^[^/?#]*", ""))
    )


def records(captures: DataFrame) -> DataFrame:
    """``captures`` (key, url, captured_at, payload) as WARC records without their closing blank lines."""
    payload = text_or_empty("payload")
    rows = captures.select(
        "key", "url", "captured_at", payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )
    firsts = (
        rows.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and first_key is not null").select("digest", "first_key")
    )
    marked = rows.join(firsts, "digest", "left")
    revisit = F.col("first_key").isNotNull() & F.coalesce(F.col("key") != F.col("first_key"), F.lit(True))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Record-ID: <{ID}"), F.coalesce(F.col("key").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Date: "), F.col("captured_at"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), target), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.lit(f"\r\nWARC-Refers-To: <{ID}"), F.col("first_key").cast("string"), F.lit(">"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return marked.select(F.concat(header, block).alias("value"), "bytes")


def write_archives(captures: DataFrame, path: str) -> None:
    """Archives of about the same size below ``path``: records of one size class together, as many as fit."""
    size = F.octet_length(text_or_empty("payload"))
    size_class = lambda n: F.size(F.filter(F.array(*map(F.lit, SIZE_CLASSES)), lambda most: most < n))
    present = sorted(r[0] for r in captures.select(size_class(size)).distinct().collect())  # one row per class
    made = records(captures)
    for number in present or [0]:
        most = RECORDS_PER_ARCHIVE * SIZE_CLASSES[0] // SIZE_CLASSES[number] if number < len(SIZE_CLASSES) else 1
        own = made.where(size_class(F.col("bytes")) == number) if len(present) > 1 else made
        own.select("value").write.mode("append").option("lineSep", END).option("compression", "gzip").option(
            "maxRecordsPerFile", most).text(path)


def parsed(archive: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an uncompressed stream: headers (lower-case names), offset, length, payload digest and size."""
    while True:
        offset = archive.tell()
        version = archive.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {offset}: {version[:40]!r}")
        head: dict = {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        left = int(head["content-length"])
        http: dict = {}
        while left:
            line = archive.readline(left)
            if not line:
                raise EOFError(f"record at {offset} is cut off")
            left -= len(line)
            if line == b"\r\n":
                break
            name, _, value = line.decode("latin-1").partition(":")
            http[name.strip().lower()] = value.strip()
        digest, size = hashlib.sha256(), left
        while left:
            piece = archive.read(min(left, 1 << 16))
            if not piece:
                raise EOFError(f"record at {offset} is cut off")
            left -= len(piece)
            digest.update(piece)
        if archive.read(4) != END.encode():
            raise ValueError(f"record at {offset} does not end with blank lines")
        yield {"head": head, "http": http, "offset": offset, "length": archive.tell() - offset, "digest": digest.hexdigest(), "size": size}


def _capture_key(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").removeprefix(ID)
    return int(text) if text.lstrip("-").isdigit() else None


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["captured_at", "key", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "archive", "offset", "length"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, types)))
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            name, rows = path.rsplit("/", 1)[-1], []
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as stream:
                for r in parsed(stream):
                    head = r["head"]
                    whole = head["warc-type"] == "response"
                    claimed = head["warc-payload-digest"].removeprefix("sha256:")
                    if whole and claimed != r["digest"]:
                        raise ValueError(f"payload at {r['offset']} of {name} does not have its digest")
                    rows.append((
                        head["warc-date"], _capture_key(head["warc-record-id"]), head["warc-type"], head.get("warc-target-uri"),
                        r["size"] if whole else int(r["http"]["content-length"]), claimed,
                        _capture_key(head.get("warc-refers-to")), name, r["offset"], r["length"],
                    ))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)


ORDER = ("url_key", "captured_at", "_none", "_key", "archive", "offset")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``: stored runs, each sorted by URL key, time and key."""
    small_batches(spark, 1)  # one archive at a time in a Python worker
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    raw = ENTRY.replace("url_key string, ", "")
    entries = files.mapInArrow(_entries, raw).select(url_key(F.col("url")).alias("url_key"), "*")
    runs = entries.withColumns({"_none": F.col("key").isNull(), "_key": F.coalesce("key", F.lit(0))})
    out = stored(runs.sortWithinPartitions(*ORDER), "capture-runs")
    small_batches(spark)
    return out


class LoserTree:
    """Index of the smallest of ``k`` heads; ``None`` is an exhausted source."""

    def __init__(self, heads: list):
        self.heads, self.k = heads, len(heads)
        self.losers = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def replace(self, head) -> None:
        """The winner's source shows its next head; one path up the tree is played again."""
        self.heads[self.winner] = head
        best, node = self.winner, (self.winner + self.k) // 2
        while node:
            if self._before(self.losers[node], best):
                self.losers[node], best = best, self.losers[node]
            node //= 2
        self.winner = best


def merged(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """Entries of sorted runs in one order.

    ``blocks``: (first key, run, entries) in the order of first keys, a run's blocks following each other;
    ``entries``: list of (key, row). A block is opened when its first key is reached, so each run has one
    open block, or two while keys are equal.
    """
    open_blocks: dict[int, deque] = {}
    slots: list[int] = []
    upcoming = next(blocks, None)
    tree: LoserTree | None = None
    while True:
        winner = None if tree is None else tree.heads[tree.winner]
        opened = False
        while upcoming is not None and (winner is None or upcoming[0] <= winner):
            _, run, entries = upcoming
            open_blocks.setdefault(run, deque()).extend(entries)
            if winner is None or upcoming[0] < winner:
                winner = upcoming[0]
            opened, upcoming = True, next(blocks, None)
        if opened:
            open_blocks = {r: q for r, q in open_blocks.items() if q}
            slots = list(open_blocks)
            tree = LoserTree([open_blocks[r][0][0] for r in slots])
        if winner is None:
            return
        queue = open_blocks[slots[tree.winner]]
        yield queue.popleft()[1]
        tree.replace(queue[0][0] if queue else None)


def capture_history(runs: DataFrame) -> DataFrame:
    """All entries of the sorted ``runs`` in one order: ENTRY columns and ``position`` from 0."""
    spark = runs.sparkSession
    total = runs.count()
    ranges = max(1, min(MAX_RANGES, -(-total // RANGE_ENTRIES)))
    borders: list[tuple] = []
    if ranges > 1:  # about 50 keys per range, at most 50 * MAX_RANGES
        share = int(min(1.0, 50 * ranges / total) * (1 << 31))
        picked = runs.where(F.pmod(F.xxhash64(*ORDER), F.lit(1 << 31)) < share).select(*ORDER).collect()
        keys = sorted(tuple(r) for r in picked)
        borders = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    fields = [f.name for f in runs.schema if f.name not in ("_none", "_key")]
    width = len(fields)
    places = [runs.columns.index(c) for c in ORDER]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive entries of the run as blocks that lie in one range each."""
        run, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keys = list(zip(*(columns[p] for p in places)))
            start = 0
            while start < len(keys):
                at = bisect_right(borders, keys[start])
                end = min(start + BLOCK_ENTRIES, len(keys))
                if at < len(borders) and not keys[end - 1] < borders[at]:
                    end = bisect_left(keys, borders[at], start, end)
                sink = io.BytesIO()
                piece = pa.RecordBatch.from_arrays([pa.array(c[start:end], t.type) for c, t in zip(columns, batch.schema)], schema=batch.schema)
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((at, *keys[start], run, seq, end - start, sink.getvalue()), block_types)],
                    names=block_names)
                start, seq = end, seq + 1

    block_names = ["range", *ORDER, "run", "seq", "n", "block"]
    block_types = [pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    block_schema = ("range int, url_key string, captured_at string, _none boolean, _key long, archive string, offset long, "
                    "run int, seq long, n long, block binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def opened(row: tuple) -> tuple:
            piece = pa.ipc.open_stream(row[-1]).read_all()
            columns = [c.to_pylist() for c in piece.columns]
            entries = list(zip(zip(*(columns[p] for p in places)), zip(*(columns[piece.schema.get_field_index(f)] for f in fields))))
            return row[1:7], row[7], entries

        for at, group in groupby(rows(), key=lambda r: r[0]):
            out, seq = [], 0
            for row in merged(opened(r) for r in group):
                out.append((at, seq, *row))
                seq += 1
                if len(out) == 4096:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    entry_types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int64(), *entry_types])], names=["range", "seq", *fields])

    assert width == len(entry_types)
    small_batches(spark, 4 * BLOCK_ENTRIES)
    blocks = stored(runs.mapInArrow(cut, block_schema), "capture-blocks")
    small_batches(spark, 16)  # blocks at a time
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range, MAX_RANGES at most
    offsets = blocks.groupBy("range").agg(F.sum("n").alias("_n")).select(
        "range", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    dealt = blocks.repartition(ranges, "range").sortWithinPartitions("range", *ORDER, "run", "seq")
    history = stored(dealt.mapInArrow(merge, f"range int, seq long, {ENTRY}"), "capture-history")
    small_batches(spark)
    return history.join(offsets, "range").select(*fields, (F.col("_before") + F.col("seq")).alias("position"))


def archived_history(captures: DataFrame) -> DataFrame:
    """Write the archives of ``captures`` to the shared folder, read them back and merge their index."""
    spark = captures.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(captures, path)
    return capture_history(read_archives(spark, path))
