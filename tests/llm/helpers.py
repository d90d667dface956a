"""Small tables for the operators' tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    """Nulls in every column, empty, long and repeated texts, ties, and columns with the operators' own names."""
    line = "one two three four five six seven eight nine ten"
    long_text = "\n".join(f"line {i} of a long text " + "word " * (i % 7) for i in range(3000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (None, line, None, None, None), (4, line, "en", "a", 9), (4, line, "en", "a", 9),
        (5, long_text, "de", "b", 1), (6, f"{line}\n{line}\n{line}\n{line}", "en", "b", 1), (7, " \n\t\n", "en", "b", 1),
        (8, "é ́x  日本語 \x1c<|endoftext|>", "fr", "b", 1), (None, None, None, None, None), (9, "x" * 20000, "en", "c", 1),
    ]
    rows = [(*r, "clash", 1, True, 0) for r in rows]
    return spark.createDataFrame(rows, DOCS + ", row string, shard int, kept boolean, position long")


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def without_file_order(df, *order):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, v) for v in r))
