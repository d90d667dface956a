"""Removal of repeated passages by overlapping windows of three lines.

Lines that hold a word are numbered; every three consecutive ones form a window (a text of one or two such
lines forms one window). With ``long_words``, one and two lines form a window as well if they hold more words
than that, in texts of any length. Windows are hashed (128 bits) where the text is, counted over all documents,
and of equal windows the first by (doc_id, text hash, position) stays. The lines of all others are covered; the
covered positions of a document are merged and removed. Every line that is removed survives somewhere
earlier. Only hashes and positions are shuffled until the last join. DataFrame functions only.

``deduplicated`` keeps to the three-line windows of its SQL unless told otherwise; ``deduplicated_documents``,
the stage of the pipeline, takes the long windows too.

Defined results: null text stays null, without lines; documents without id come after the others; lines
without a word form no window and stay, unless nothing else is left: then the text is empty. Rows equal in id
and text are one document to the windows and get the same result. Texts of any length are cut whole. Other columns
don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import let, lines_with_words, stored, text_or_empty, words_of

LINES = 3
LONG_WORDS = 50


def _window_hashes(text: Column, width: int, long_words: int | None) -> Column:
    """Array of struct(start, lines, window): the first line, the number of lines and the hash."""

    def of(lines: Column) -> Column:
        def hashed(starts: Column, count: int) -> Column:
            return F.transform(starts, lambda i: F.struct(
                i.alias("start"), F.least(F.size(lines), F.lit(count)).alias("lines"),
                F.unhex(F.md5(F.concat_ws("\n", F.slice(lines, i + 1, count)))).alias("window")))

        def starts(count: int) -> Column:
            return F.sequence(F.lit(0), F.greatest(F.size(lines) - count, F.lit(0)))

        def long_ones(counts: Column, count: int) -> Column:
            # a text of ``count`` lines is a window already
            words = lambda i: F.aggregate(F.slice(counts, i + 1, count), F.lit(0), lambda a, b: a + b)
            return hashed(F.filter(starts(count), lambda i: (F.size(lines) > count) & (words(i) > long_words)), count)

        found = hashed(starts(width), width)
        if long_words is not None:
            found = F.concat(found, let(
                F.transform(lines, lambda line: F.size(words_of(line))),
                lambda counts: F.concat(*(long_ones(counts, count) for count in range(1, width)))))
        return F.when(F.size(lines) > 0, found)

    return let(lines_with_words(text), of)


def windows(docs: DataFrame, width: int = LINES, long_words: int | None = None) -> DataFrame:
    """(doc_id, text_hash, start, lines, window) of every window of every text."""
    text = text_or_empty()
    found = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.explode(_window_hashes(text, width, long_words)).alias("w"))
    return found.select("doc_id", "text_hash", "w.*")


def covered_positions(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): start and lines of the windows of each document that occur earlier."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
    repeated = (
        found.groupBy("window").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .where("_n > 1").select("window", "_first")
    )
    later = found.join(repeated, "window").where(place != F.col("_first"))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "lines")).alias("spans"))


def _without(text: Column, spans: Column) -> Column:
    """(text, n_lines, n_removed) without the lines that the windows at ``spans`` cover."""

    def cut(lines: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(r"[^\x20\x09-\x0D]"))

        def with_full(full: Column) -> Column:
            covered = F.array_distinct(F.flatten(F.transform(
                spans, lambda s: F.sequence(s["start"], s["start"] + s["lines"] - 1)
            )))

            def with_covered(covered: Column) -> Column:
                gone = F.transform(covered, lambda p: F.get(full, p))
                stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
                left = F.when(F.size(covered) == F.size(full), F.lit("")).otherwise(
                    F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
                return F.struct(left.alias("text"), F.size(full).cast("long").alias("n_lines"),
                                F.size(covered).cast("long").alias("n_removed"))

            return let(covered, with_covered)

        return let(full, with_full)

    return let(F.split(text, "\n"), cut)


def cleaned(docs: DataFrame, width: int = LINES, long_words: int | None = None) -> DataFrame:
    """``docs`` with all columns as struct ``row``, and ``cleaned`` = struct(text, n_lines, n_removed)."""
    spans = covered_positions(stored(windows(docs, width, long_words), "line-windows"))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.xxhash64(text_or_empty("row.text")).alias("text_hash")
    )
    joined = rows.join(
        spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left",
    )
    whole = F.col("row.text")
    untouched = F.struct(
        whole.alias("text"), F.size(lines_with_words(text_or_empty(whole))).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"),
    )
    return joined.select("row", F.when(F.col("spans").isNull(), untouched).otherwise(
        _without(whole, F.col("spans"))).alias("cleaned"))


def deduplicated(docs: DataFrame, width: int = LINES, long_words: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed and the text that is left."""
    out = cleaned(docs, width, long_words)
    return out.select("row.doc_id", "cleaned.n_lines", "cleaned.n_removed", "cleaned.text")


def deduplicated_documents(docs: DataFrame, width: int = LINES, long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs`` with the text that is left; documents of which nothing is left go (all of it stands elsewhere).

    A column ``n_chars``, if there is one, follows the new text.
    """
    out = cleaned(docs, width, long_words).where((F.col("cleaned.n_removed") == 0) | (F.col("cleaned.text") != ""))
    changed = {"text": F.col("cleaned.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cleaned.n_removed") == 0, F.col("row.n_chars")).otherwise(
            F.length("cleaned.text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
