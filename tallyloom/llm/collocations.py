"""Phrase collocations by set-oriented mining (SETM) over sorted occurrence relations.

An occurrence is (piece, position, item); a relation holds the occurrences of frequent items, sorted by piece and
position. Length 1 has the words. Length k + 1 comes from length k by a merge join of the relation with itself on the
piece and the adjacent position: two neighbouring frequent phrases of k words that share k - 1 of them are a phrase of
k + 1 words. Its groups are counted over all data, and the occurrences are semi-joined with the frequent groups before
they are persisted and extended further.

Pieces never leave their block (the texts of one language that a task reads together, up to ``BLOCK_WORDS`` words or
one longer text). A block has a vocabulary and a relation, both stored as rows of at most ``CHUNK_WORDS`` words, so no row,
page or batch grows with the block. A chunk of the relation also holds the ``max_words - 1`` words after it, so that the
merge join is array work inside a chunk; an occurrence is counted in the chunk that it begins in. Groups are counted for
about a block's words first and then by Spark, so a phrase with a third of all occurrences adds one row for each; frequent
groups come back to the blocks by equi-joins, and meet the chunks sorted by block. Items are numbered over all languages
and blocks.

Defined results: a null text has no words, a null language is ``und``; texts of any length count whole; repeated rows
count repeatedly; doc_id and further columns are not read; phrases equal in score and count are ordered by their bytes;
an empty table gives no row. Counts, products and scores are exact (38 decimal digits).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import numbered, small_batches, stored, text_or_empty

BLOCK_WORDS = 1 << 19
CHUNK_WORDS = 1 << 15  # words, or list entries, of one stored row
TEXTS_TOGETHER = 1 << 20  # characters that are cut into words at a time
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
SCALE = 1_000_000
RELATION = "block long, chunk int, until int, pieces binary, positions binary, items binary"
# a row has up to three arrays of CHUNK_WORDS numbers: pages, row groups and batches of few rows
WIDE = {"parquet.block.size": str(32 << 20), "parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "64"}
SCAN_ROWS = 16


@contextmanager
def _wide_rows(spark: SparkSession) -> Iterator[None]:
    """Scans hold ``SCAN_ROWS`` rows at a time, Python batches about 4 MB."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, str(SCAN_ROWS))
    small_batches(spark, 1 << 16, 4 << 20)
    try:
        yield
    finally:
        spark.conf.set(key, before)
        small_batches(spark)


def _steps(values: np.ndarray) -> bytes:
    """Rising numbers as their differences, which compress well."""
    return np.diff(values, prepend=0).astype("<i4").tobytes()


def _rising(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i4"), dtype=np.int64)


class Block:
    """Words of texts of one language, cut and numbered as they come."""

    def __init__(self, lang: str):
        self.lang = lang
        self.numbers: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.size = self.opened = 0
        kind = np.zeros(256, np.uint8)
        kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.kind, self.lower = kind, lower

    def add(self, texts: list[str]) -> None:
        """All separators are single bytes, so words are found in the UTF-8 bytes; a line feed parts the texts."""
        raw = np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)
        kind = self.kind[raw]
        inside = kind == 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        piece = (np.cumsum(kind == 2, dtype=np.int32)[begin] + self.opened).astype(np.int32)
        self.opened += int((kind == 2).sum())
        at = np.flatnonzero(begin[inside])
        data = self.lower[raw[inside]].tobytes()
        words = pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        numbers = self.numbers
        own = [numbers.setdefault(w, len(numbers)) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        self.words.append(np.array(own, np.int32)[coded.indices.to_numpy()])
        self.pieces.append(piece)
        self.size += len(at)

    def records(self, number: int, chunk: int, ahead: int) -> Iterator[tuple]:
        """Rows of the block: parts of its vocabulary, then chunks of its relation with ``ahead`` words of the next one."""
        words, pieces = np.concatenate(self.words), np.concatenate(self.pieces)
        counts = np.bincount(words, minlength=len(self.numbers))
        names = list(self.numbers)
        for at in range(0, len(names), chunk):
            some = slice(at, at + chunk)
            yield (number, self.lang, at, [w.decode() for w in names[some]], counts[some], *[None] * 5)
        # a piece of one word has no neighbours, but its number parts the pieces beside it
        for i, at in enumerate(range(0, len(words), chunk)):
            end = min(at + chunk, len(words))
            some = slice(at, min(end + ahead, len(words)))
            yield (number, self.lang, *[None] * 3, i, end, _steps(pieces[some]), _steps(np.arange(some.start, some.stop)),
                   words[some].astype("<i4").tobytes())


def occurrences(docs: DataFrame, max_words: int = 3) -> DataFrame:
    """Stored blocks of all words: rows (block, lang, first, words, counts) and (block, lang, chunk, until, pieces, positions, items).

    An item is a place in the words of its block; ``first`` is the place of a row's first word. Occurrences from position
    ``until`` on are those of the next chunk.
    """
    schema = RELATION.replace(",", ", lang string, first int, words array<string>, counts array<long>,", 1)
    types = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int32(), pa.int32(), *[pa.binary()] * 3]
    names = ["block", "lang", "first", "words", "counts", "chunk", "until", "pieces", "positions", "items"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0

        def out(block: Block) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for row in block.records(made, CHUNK_WORDS, max_words - 1):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)
            made += 1

        blocks: dict[str, Block] = {}
        for batch in batches:
            waiting: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting.setdefault(lang, []).append(text)
            for lang, texts in waiting.items():
                start = size = 0
                for i, text in enumerate([*texts, None]):
                    if i > start and (text is None or size + len(text) > TEXTS_TOGETHER):
                        block = blocks.setdefault(lang, Block(lang))
                        block.add(texts[start:i])
                        if block.size > BLOCK_WORDS:
                            yield from out(blocks.pop(lang))
                        start, size = i, 0
                    size += len(text or "")
        for block in blocks.values():
            if block.size:
                yield from out(block)

    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    # blocks are numbered inside their task
    numbers = F.shiftleft(F.spark_partition_id().cast("long"), 33) + F.col("block")
    return stored(rows.mapInArrow(cut, schema).withColumn("block", numbers), "word-blocks", "zstd", **WIDE)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        for r in range(batch.num_rows):
            yield [column[r] for column in batch.columns]


def _lists(frequent: DataFrame) -> DataFrame:
    """(block, codes, ids), codes as steps, of (block, code, id): the rows of a task, those of a block together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            block, code, number = (np.concatenate([b.column(i).to_numpy() for b in some]) for i in range(3))
            order = np.lexsort((code, block))
            block, code, number = block[order], code[order], number[order]
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            parts = [slice(at, min(at + CHUNK_WORDS, b)) for a, b in zip(edges, edges[1:]) for at in range(a, b, CHUNK_WORDS)]
            return pa.RecordBatch.from_arrays([
                pa.array([int(block[p.start]) for p in parts], pa.int64()),
                pa.array([np.diff(code[p], prepend=0).astype("<i8").tobytes() for p in parts], pa.binary()),
                pa.array([number[p].astype("<i4").tobytes() for p in parts], pa.binary()),
            ], names=["block", "codes", "ids"])

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= BLOCK_WORDS:
                yield out(waiting)
                waiting, size = [], 0
        if size:
            yield out(waiting)

    return frequent.select("block", "code", F.col("id").cast("long").alias("id")).mapInArrow(pack, "block long, codes binary, ids binary")


def _translated(relation: DataFrame, frequent: DataFrame, label: str) -> DataFrame:
    """The stored relation of frequent items: ``relation`` with its codes replaced by ids.

    ``frequent`` (block, code, id) has the frequent ones of the codes that a block holds: as many as it has words at most.
    Its lists come before the chunks of their block.
    """
    lists = _lists(frequent).select(
        "block", F.lit(-1).alias("chunk"), F.lit(0).alias("until"), F.col("codes").alias("pieces"),
        F.lit(None).cast("binary").alias("positions"), F.col("ids").alias("items"))
    rows = lists.unionByName(relation).repartition("block").sortWithinPartitions("block", "chunk")

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, some = None, []
        codes = ids = np.empty(0, np.int64)
        for block, chunk, until, pieces, positions, items in _rows(batches):
            if block != known:
                known, some, codes, ids = block, [], np.empty(0, np.int64), np.empty(0, np.int64)
            items = np.frombuffer(items.as_buffer(), "<i4").astype(np.int64)
            if chunk.as_py() < 0:
                some.append((np.cumsum(np.frombuffer(pieces.as_buffer(), "<i8")), items))
                continue
            if some:
                codes, ids = (np.concatenate(arrays) for arrays in zip((codes, ids), *some))
                order = np.argsort(codes)
                codes, ids, some = codes[order], ids[order], []
            if not len(codes):
                continue
            pieces, positions = _rising(pieces.as_buffer()), _rising(positions.as_buffer())
            keys, following = (items, slice(None)) if label == "words" else _neighbours(pieces, positions, items)
            at = np.minimum(np.searchsorted(codes, keys), len(codes) - 1)
            kept = codes[at] == keys
            if kept.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()], pa.int64()), pa.array([chunk.as_py()], pa.int32()), pa.array([until.as_py()], pa.int32()),
                    pa.array([_steps(pieces[following][kept])], pa.binary()), pa.array([_steps(positions[following][kept])], pa.binary()),
                    pa.array([ids[at][kept].astype("<i4").tobytes()], pa.binary()),
                ], names=["block", "chunk", "until", "pieces", "positions", "items"])

    return stored(rows.mapInArrow(translate, RELATION), f"relation-{label}", "zstd", **WIDE)


def _neighbours(pieces: np.ndarray, positions: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge join of a sorted relation with itself on piece and adjacent position: (key of both items, place of the first)."""
    places = np.flatnonzero((pieces[1:] == pieces[:-1]) & (positions[1:] == positions[:-1] + 1))
    return items[places] << 32 | items[places + 1], places


def _extended(relation: DataFrame, counted: bool) -> DataFrame:
    """(code, n), or (block, code), of the phrases one item longer, counted for some chunks together; code: both items in one long.

    Chunks of a block mostly come one after the other, so (block, code) rarely comes twice.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: int, some: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            codes, n = np.unique(np.concatenate(some), return_counts=True)
            for at in range(0, len(codes), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [pa.array(codes[part]), pa.array(n[part] if counted else np.full(len(codes[part]), block))]
                yield pa.RecordBatch.from_arrays(columns, names=["code", "n" if counted else "block"])

        last, some, size = None, [], 0
        for block, until, pieces, positions, items in _rows(batches):
            block, positions = block.as_py(), _rising(positions.as_buffer())
            if some and (size >= BLOCK_WORDS or not counted and block != last):
                yield from out(last, some)
                some, size = [], 0
            keys, places = _neighbours(_rising(pieces.as_buffer()), positions, np.frombuffer(items.as_buffer(), "<i4").astype(np.int64))
            last = block
            some.append(keys[positions[places] < until.as_py()])
            size += len(some[-1])
        if some:
            yield from out(last, some)

    return relation.select("block", "until", "pieces", "positions", "items").mapInArrow(
        count, "code long, " + ("n long" if counted else "block long"))


def _numbered(groups: DataFrame, order: list[str], label: str) -> DataFrame:
    """Frequent groups with an id; ids of neighbours share a long, so there may be 2^31 of them."""
    out = stored(numbered(groups, order, label=label).withColumnRenamed("position", "id"), label)
    if (out.agg(F.max("id")).first()[0] or 0) >= 1 << 31:
        raise OverflowError(f"more than 2^31 {label}")
    return out


def levels(docs: DataFrame, max_words: int = 3, least: int = 10) -> tuple[DataFrame, list[DataFrame]]:
    """(words per lang; of each length the frequent phrases: id, lang, phrase, f, left, right, heads, tails).

    ``left`` and ``right`` are ids of the phrase without its last and first word, ``heads`` and ``tails`` the counts of
    its first 1, 2, ... and last 1, 2, ... words.
    """
    blocks = occurrences(docs, max_words)
    with _wide_rows(docs.sparkSession):
        return _levels(blocks, max_words, least)


def _levels(blocks: DataFrame, max_words: int, least: int) -> tuple[DataFrame, list[DataFrame]]:
    each = blocks.select("block", "lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select(
        "block", "lang", F.col("w.words").alias("phrase"), F.col("w.counts").alias("n"))
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    totals = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = each.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    nothing = F.array().cast("array<long>")
    known = _numbered(frequent, ["lang", "phrase"], "frequent-words").withColumns({"heads": nothing, "tails": nothing})
    found = [known]
    if max_words == 1:
        return totals, found
    places = blocks.select("block", "lang", "first", F.posexplode("words").alias("at", "phrase")).withColumn(
        "code", (F.col("first") + F.col("at")).cast("long"))
    mine = places.join(known.select("lang", "phrase", "id"), ["lang", "phrase"]).select("block", "code", "id")
    chunks = blocks.where(F.col("chunk").isNotNull()).select("block", "chunk", "until", "pieces", "positions", "items")
    relation = _translated(chunks, mine, "words")
    for length in range(2, max_words + 1):
        counts = _extended(relation, True).groupBy("code").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        groups = _numbered(counts, ["code"], f"frequent-{length}").withColumns({
            "left": F.shiftright("code", 32), "right": F.col("code").bitwiseAND(F.lit((1 << 32) - 1))})
        a = known.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("_a"), F.col("f").alias("_f"), F.col("heads").alias("_h"))
        b = known.select(F.col("id").alias("right"), F.col("phrase").alias("_b"), F.col("f").alias("_g"), F.col("tails").alias("_t"))
        whole = groups.join(a, "left").join(b, "right").select(
            "id", "code", "lang", F.concat("_a", F.lit(" "), F.substring_index("_b", " ", -1)).alias("phrase"), "f", "left", "right",
            F.concat("_h", F.array("_f")).alias("heads"), F.concat("_t", F.array("_g")).alias("tails"))
        known = stored(whole, f"phrases-{length}")
        found.append(known)
        if length < max_words:
            mine = _extended(relation, False).join(groups.select("code", "id"), "code").select("block", "code", "id")
            relation = _translated(relation, mine, f"phrases-{length}")
    return totals, found


def _lowest_cut(length: int) -> Column:
    """(score, k, l, r) of the lowest cut of a phrase of ``length`` words; ties go to the smallest k."""
    f = F.col("f").cast("decimal(38,0)")
    cuts = []
    for k in range(1, length):
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(length - k - 1))
        both = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
        top = (f * f).cast("decimal(31,0)") * F.lit(SCALE)
        cuts.append(F.struct(((top - top % both) / both).cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def mined(docs: DataFrame, max_words: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words per language: lang, rank, phrase, a, l, r, n, score.

    A phrase needs ``least`` occurrences. One that lies inside a longer frequent phrase with at least ``inside_percent``
    of its occurrences goes. If any longer phrase covers it so, one of a single word more does, as that is no rarer.
    """
    totals, found = levels(docs, max_words, least)
    parts = []
    for length, phrases in enumerate(found[1:], 2):
        kept = phrases
        if length < max_words:
            longer = found[length].select(F.explode(F.array("left", "right")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("_longest"))
            kept = phrases.join(longer, "id", "left").where(
                F.col("_longest").isNull() | (F.lit(100) * F.col("_longest") < F.lit(inside_percent) * F.col("f")))
        cut = kept.withColumn("cut", _lowest_cut(length))
        parts.append(cut.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
    if not parts:
        raise ValueError("phrases have two words at least")
    all_lengths = parts[0]
    for part in parts[1:]:
        all_lengths = all_lengths.unionByName(part)
    # ranks by range: the candidates of a language spread over tasks
    keyed = stored(all_lengths.withColumns({"_score": -F.col("score"), "_a": -F.col("a")}), "candidates")
    placed = numbered(keyed, ["lang", "_score", "_a", "phrase"], label="ranked-candidates")
    counts = keyed.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    first = numbered(counts, ["lang"], ["_n"], "ranked-languages").select("lang", F.col("_n_before").alias("_first"))
    best = placed.join(first, "lang").withColumn("rank", F.col("position") - F.col("_first") + 1).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
