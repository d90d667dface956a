"""Phrase mining against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import empty_documents, odd_documents
from pyspark.sql import functions as F

from tallyloom.llm import collocations


def plain(rows, max_words=3, least=10, percent=50, top=2000):
    """Rows: (lang, text)."""
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for n in range(1, max_words + 1):
                for i in range(len(found) - n + 1):
                    counts[lang][tuple(found[i:i + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "x") for r in rows], "lang string, text string, phrase string, block int, items string").repartition(4)


def texts(seed, n):
    rng, out = random.Random(seed), []
    common = ["the", "Of", "and", "New", "york", "City", "a", "é", "ÉA", "日本", "x\x1cy", "\x85"]
    for _ in range(n):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\r", " ? "]) for w in words)
        out.append((rng.choice(["en", "de", None, "und", "en"]), text))
    return out


@pytest.mark.parametrize("length", [2, 3, 4])
def test_phrases_equal_plain_counting(spark, length, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 300)
    monkeypatch.setattr(collocations, "TEXTS_TOGETHER", 500)
    rows = texts(length, 400)
    want = plain(rows, length, 5)
    assert len(want) > 100
    assert sorted(map(tuple, collocations.mined(frame(spark, rows), length, 5).collect())) == want
    assert sorted(map(tuple, collocations.mined(frame(spark, rows), length, 5, top=7).collect())) == plain(rows, length, 5, top=7)


@pytest.mark.parametrize("length, chunk", [(2, 1), (3, 2), (4, 3), (4, 50)])
def test_phrases_across_chunks_are_counted_once(spark, length, chunk, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 300)
    monkeypatch.setattr(collocations, "TEXTS_TOGETHER", 500)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    rows = texts(7, 80)
    want = plain(rows, length, 3)
    assert want
    assert sorted(map(tuple, collocations.mined(frame(spark, rows), length, 3).collect())) == want


def test_no_stored_row_grows_with_its_block(spark, monkeypatch):
    seen, keep = [], collocations.stored

    def store(df, label, *given, **options):
        seen.append((label, keep(df, label, *given, **options)))
        return seen[-1][1]

    monkeypatch.setattr(collocations, "stored", store)
    text = " ".join(f"w{i % 70_000} a" for i in range(150_000))
    before = spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    collocations.levels(frame(spark, [("en", text)]), least=2)
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == before
    blocks = [df for label, df in seen if label == "word-blocks" or label.startswith("relation-")]
    assert len(blocks) == 3
    for df in blocks:
        widths = [F.max(F.size(c) if kind.startswith("array") else F.octet_length(c) / 4)
                  for c, kind in df.dtypes if kind == "binary" or kind.startswith("array")]
        assert max(x for x in df.agg(*widths).first() if x is not None) <= (1 << 15) + 2


def test_covered_phrases_go_and_ties_are_in_order_of_bytes(spark):
    rows = [("en", "new york city")] * 12 + [("en", "new york")] * 12 + [("en", "b c. é f. \U0001f600 g. ￿ h")] * 10
    got = sorted(map(tuple, collocations.mined(frame(spark, rows)).collect()))
    assert got == plain(rows)
    assert [r[2] for r in got if r[4] == 10] == ["b c", "é f", "￿ h", "\U0001f600 g"]
    assert "york city" not in [r[2] for r in got]


def test_one_very_long_text_of_one_hot_phrase(spark):
    rows = [("en", "a a a a b " * 400_000), (None, "")]
    got = collocations.mined(frame(spark, rows)).collect()
    assert {r.phrase: (r.a, r.l, r.r, r.n) for r in got} == {p: (a, l, r, n) for _, _, p, a, l, r, n, _ in plain(rows)}


def test_odd_and_empty_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert sorted(map(tuple, collocations.mined(docs).collect())) == plain(rows)
    assert collocations.mined(empty_documents(spark)).collect() == []
    assert collocations.mined(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []
