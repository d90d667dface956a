"""Token files: one wavelet matrix per shard, with rank and select, written and read by Spark.

Texts are encoded where they are and their ids, two bytes each, are stored: what follows reads them twice (the
range bounds, then the rows), the encoder runs once. Ranges are those of doc_id, the text's hash and the stored
row's number, so that repeats of one row spread over tasks. Each partition
becomes consecutive shards of about ``SHARD_TOKENS`` ids. A shard file holds the bit-planes of its ids from
the highest bit down (each plane stably sorted by the bits above), a rank directory and the documents' ids
and lengths; planes are compressed one by one. ``WaveletMatrix`` answers access, counting and occurrence
lookup from that one file; ``ids()`` restores the whole sequence.

Defined results: null text is empty and holds only the end id; documents without id come last; rows with
equal ids follow each other in the order of their text's hash; texts longer than a shard make a shard of
their own. Columns besides doc_id and text are not read. An empty table gives no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import scratch_path, small_batches, stored, text_or_empty
from tallyloom.llm.tokens import blocks, library_encoder

MAGIC = b"TLWM\x01\x00\x00\x00"
HEAD = "<8sIIQQI"  # magic, partition, sequence, ids, documents, levels
SHARD_TOKENS = 1 << 20
SUPERBLOCK = 512  # bits per entry of the rank directory


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, text_hash, n_tokens, ids): ids with the end id, little-endian, two bytes each (four if needed)."""
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for part in blocks(texts):
                ids, counts = encoder.encode(texts[part])
                ends = np.cumsum(counts)
                rows = [np.append(ids[e - n:e], end_id) for e, n in zip(ends, counts)]
                rows = [r.astype("<u2") if r.max() < 1 << 16 else r.astype("<u4") for r in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[part.start:part.stop], batch.column(1)[part.start:part.stop],
                    pa.array(counts + 1, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary()),
                ], names=["doc_id", "text_hash", "n_tokens", "ids"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(encode, "doc_id long, text_hash long, n_tokens long, ids binary")


def _section(raw: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=1).compress(raw)
    return struct.pack("<QQ", len(packed), len(raw)) + packed


def build(partition: int, sequence: int, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """The file of one shard."""
    levels = max(1, int(ids.max(initial=0)).bit_length())
    out = [struct.pack(HEAD, MAGIC, partition, sequence, len(ids), len(doc_ids), levels)]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    out.append(_section(known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<i8").tobytes()))
    order = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    for level in range(levels - 1, -1, -1):
        bits = ((order >> level) & 1).astype(bool)
        words = np.packbits(bits, bitorder="little")
        words = np.concatenate([words, np.zeros(-len(words) % (SUPERBLOCK // 8), np.uint8)])
        sums = np.bitwise_count(words).reshape(-1, SUPERBLOCK // 8).sum(axis=1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(sums)]).astype("<u4")
        out += [_section(words.tobytes()), _section(directory.tobytes())]
        # places first: masks of random bits are several times slower than taking places
        order = np.concatenate([order.take(np.flatnonzero(~bits)), order.take(np.flatnonzero(bits))])
    return b"".join(out)


class WaveletMatrix:
    """Reader of one shard file; planes are unpacked when they are asked for."""

    def __init__(self, raw: bytes | memoryview):
        self._raw = memoryview(raw)
        magic, self.partition, self.sequence, self.n, self.documents, self.levels = struct.unpack_from(HEAD, self._raw, 0)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self._at, place = [], struct.calcsize(HEAD)
        for _ in range(1 + 2 * self.levels):
            packed, size = struct.unpack_from("<QQ", self._raw, place)
            self._at.append((place + 16, packed, size))
            place += 16 + packed
        table, d = self._unpacked(0), self.documents
        known = np.frombuffer(table, np.uint8, d)
        numbers = np.frombuffer(table, "<i8", 2 * d, d)
        self.doc_ids = [int(v) if k else None for k, v in zip(known, numbers[:d])]
        self.lengths = numbers[d:]
        self._planes: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def _unpacked(self, section: int) -> bytes:
        place, packed, size = self._at[section]
        return zstandard.ZstdDecompressor().decompress(self._raw[place:place + packed], max_output_size=size) if size else b""

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Bits, ones before each superblock, and the number of zeros of the plane of a bit."""
        if level not in self._planes:
            section = 1 + 2 * (self.levels - 1 - level)
            words = np.frombuffer(self._unpacked(section), np.uint8)
            directory = np.frombuffer(self._unpacked(section + 1), "<u4")
            self._planes[level] = words, directory, self.n - int(directory[-1])
        return self._planes[level]

    def _bit(self, level: int, i: int) -> int:
        return int(self._plane(level)[0][i >> 3] >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        words, directory, _ = self._plane(level)
        block = i // SUPERBLOCK
        start, whole = block * SUPERBLOCK // 8, i >> 3
        ones = int(directory[block]) + int(np.bitwise_count(words[start:whole]).sum())
        return ones + (int(words[whole] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0)

    def _place_of_one(self, level: int, k: int) -> int:
        words, directory, _ = self._plane(level)
        block = int(np.searchsorted(directory, k, side="right")) - 1
        start = block * SUPERBLOCK // 8
        bits = np.unpackbits(words[start:start + SUPERBLOCK // 8], bitorder="little")
        return block * SUPERBLOCK + int(np.flatnonzero(bits)[k - int(directory[block])])

    def _place_of_zero(self, level: int, k: int) -> int:
        words, directory, _ = self._plane(level)
        zeros = np.arange(len(directory)) * SUPERBLOCK - directory
        block = int(np.searchsorted(zeros, k, side="right")) - 1
        start = block * SUPERBLOCK // 8
        bits = np.unpackbits(words[start:start + SUPERBLOCK // 8], bitorder="little")
        return block * SUPERBLOCK + int(np.flatnonzero(bits == 0)[k - int(zeros[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level in range(self.levels - 1, -1, -1):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self._plane(level)[2] + ones if bit else i - ones
            value |= bit << level
        return value

    def _span(self, token: int, end: int) -> tuple[int, int]:
        start = 0
        for level in range(self.levels - 1, -1, -1):
            ones = self._ones(level, start), self._ones(level, end)
            if token >> level & 1:
                zeros = self._plane(level)[2]
                start, end = zeros + ones[0], zeros + ones[1]
            else:
                start, end = start - ones[0], end - ones[1]
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """How often ``token`` occurs before place ``end``."""
        if token >> self.levels:
            return 0
        start, stop = self._span(token, self.n if end is None else end)
        return stop - start

    def occurrence(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``token``; IndexError if there are fewer."""
        if k < 0 or k >= self.count(token):
            raise IndexError(f"token {token} occurs {self.count(token)} times")
        place = self._span(token, self.n)[0] + k
        for level in range(self.levels):
            zeros = self._plane(level)[2]
            if token >> level & 1:
                place = self._place_of_one(level, place - zeros)
            else:
                place = self._place_of_zero(level, place)
        return place

    def ids(self) -> np.ndarray:
        """All ids, restored from the lowest plane up."""
        order = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels):
            words, _, zeros = self._plane(level)
            bits = np.unpackbits(words, count=self.n, bitorder="little").view(bool)
            above = np.empty_like(order)
            above[np.flatnonzero(~bits)] = order[:zeros]
            above[np.flatnonzero(bits)] = order[zeros:] | order.dtype.type(1 << level)
            order = above
            del self._planes[level]
        return order.astype(np.uint32)


def write_shards(tokens: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Shard files below ``path`` in ascending doc_id order, from stored (doc_id, text_hash, row, n_tokens, ids)."""
    spark = tokens.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc(), F.col("row").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sequence = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        pieces: list[np.ndarray] = []
        size = 0

        def file() -> pa.RecordBatch:
            raw = build(partition, sequence, doc_ids, [len(p) for p in pieces], np.concatenate(pieces))
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["value"])

        for batch in batches:
            for doc_id, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if pieces and size + n > shard_tokens:
                    yield file()
                    doc_ids, pieces, size, sequence = [], [], 0, sequence + 1
                raw = ids.as_buffer()
                doc_ids.append(doc_id)
                pieces.append(np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32))
                size += n
        if pieces:
            yield file()

    small_batches(spark, 64)
    dealt = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")
    files = dealt.mapInArrow(shards, "value binary")
    # the text writer puts out the bytes of a string as they are: one record, one file
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    small_batches(spark)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = WaveletMatrix(content.as_buffer())
                raw = shard.ids().astype("<u4").tobytes()
                ends = np.cumsum(shard.lengths)
                sums = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends, shard.lengths)]
                d = shard.documents
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard.partition] * d, pa.int32()), pa.array([shard.sequence] * d, pa.int32()),
                    pa.array(ends - shard.lengths, pa.int64()), pa.array(shard.doc_ids, pa.int64()),
                    pa.array(shard.lengths, pa.int64()), pa.array(sums, pa.int64()),
                ], names=["partition", "sequence", "inside", "doc_id", "n_tokens", "ids_crc32"])

    small_batches(spark, 1)  # one file at a time in a Python worker
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = stored(files.mapInArrow(
        decode, "partition int, sequence int, inside long, doc_id long, n_tokens long, ids_crc32 long"), "token-documents")
    small_batches(spark)
    shards = rows.groupBy("partition", "sequence").agg(F.sum("n_tokens").alias("_n"))
    before = Window.partitionBy("partition").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("partition").agg(F.sum("_n").alias("_all"))  # one row per partition of the writer
    upto = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("partition", F.coalesce(F.sum("_all").over(upto), F.lit(0)).alias("_before"))
    places = shards.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(offsets, "partition").select(
        "partition", "sequence", (F.col("_before") + F.col("_inside")).alias("_start"))
    return rows.join(places, ["partition", "sequence"]).select(
        "doc_id", (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Encode ``docs``, write the shard files to the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    rows = encoded(docs, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id())
    write_shards(stored(rows, "token-ids", "zstd"), path)
    return read_shards(spark, path)
