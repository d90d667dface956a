"""Values, not counts, of the operators on odd rows, empty tables and very long texts."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import empty_documents, labels, odd_documents
from pyspark.sql import functions as F
from test_queries import near_classes
from tokenizers import Tokenizer

from tallyloom.llm import (
    line_dedup, merge_replay, near_dedup, packing, quality_classifier, quality_rules, sharding, warc, wavelet,
)

BYTE, RANKS, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def bag(rows):
    return Counter(tuple(r) for r in rows)


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_token_files_of_odd_rows(spark):
    docs, tokenizer = odd_documents(spark), library(BYTE)
    want = Counter()
    for r in docs.collect():
        ids = ids_of(tokenizer, r.text, 0)
        want[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = wavelet.written_and_read(docs, BYTE).collect()
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    known = [r.doc_id for r in ordered if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in ordered[len(known):])


def test_replay_of_odd_rows(spark):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs, want = odd_documents(spark), Counter()
    for r in docs.collect():
        ids = own.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert bag(merge_replay.encoded_and_decoded(docs, RANKS, public_tokenizers.PATTERN).collect()) == want


def test_packing_of_odd_rows(spark):
    """Pieces of each row put together are its ids; rows that repeat are packed as often."""
    docs, tokenizer = odd_documents(spark), library(WORD)
    rows = packing.packed(docs, WORD, length=256).toPandas()
    want = Counter()
    for r in docs.collect():
        want[r.doc_id, len(ids_of(tokenizer, r.text, 1))] += 1
    whole = rows.assign(doc_id=rows.doc_id.astype(object).where(rows.doc_id.notna(), None))
    lengths = Counter()
    for r in whole.itertuples():
        lengths[r.doc_id, r.doc_tokens] += r.length
    assert lengths == Counter({(d, n): n * times for (d, n), times in want.items()})
    for r in docs.where("doc_id in (5, 6, 8, 9)").collect():
        ids = ids_of(tokenizer, r.text, 1)
        for p in whole[whole.doc_id == r.doc_id].itertuples():
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32


def test_classes_of_odd_rows(spark):
    docs = odd_documents(spark)
    texts = {i: r.text or "" for i, r in enumerate(docs.collect())}
    ids = [r.doc_id for r in docs.collect()]
    classes = near_classes(texts)
    members = {}
    for i, c in classes.items():
        members.setdefault(c, []).append(ids[i])
    want = Counter()
    for i, c in classes.items():
        known = [d for d in members[c] if d is not None]
        want[ids[i], min(known) if known else None] += 1
    assert bag(near_dedup.classes(docs).collect()) == want


def test_shards_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = sharding.sharded(docs, sharding.Settings(shards=3)).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert bag((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by_shard = Counter(r.shard for r in got)
    assert max(by_shard.values()) - min(by_shard[s] for s in range(3)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in by_shard.items())


def plain_measures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rules_on_odd_rows(spark):
    docs = odd_documents(spark)
    got = quality_rules.judge(docs, labels(spark)).collect()
    want = Counter()
    for r in docs.collect():
        n, chars, symbols, dup, repeat = plain_measures(r.text)
        failed = n < 20 or 100 * repeat > 30 * n
        want[r.doc_id, n, chars, symbols, dup, repeat, failed, not failed] += 1
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want


def test_copies_are_one_trial(spark):
    """Seven hundred copies of one good text do not make seven hundred independent trials."""
    clean = " ".join(f"w{i}" for i in range(30))
    docs = [(i, clean, "en") for i in range(700)] + [(1000 + i, f"{clean} b{i} {'#' * 40}", "en") for i in range(30)]
    marks = labels(spark, [(i, int(i < 1000), 0) for i, _, _ in docs])
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert quality_rules.judge(frame, marks).where("not kept").count() == 0
    apart = [(i, f"{t} c{i}" if i < 1000 else t, lang) for i, t, lang in docs]
    frame = spark.createDataFrame(apart, "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality_rules.judge(frame, marks).where("not kept").collect()} == set(range(1000, 1030))


def plain_statistics(text):
    raw = text.encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, size, rows = max(len(words), 1), max(len(raw), 1), max(len(lines), 1)
    count = lambda some: sum(b in some for b in raw)
    shares = [c / size for c in Counter(raw).values()]
    return [
        math.log1p(len(words)), math.log1p(len(raw)), sum(map(len, words)) / n, count(range(65, 91)) / size, count(range(97, 123)) / size,
        count(range(48, 58)) / size, count(b"#*$%&|<>") / size, count(b"!") / size, count(b".") / size, count(b",;:") / size,
        count(range(128, 256)) / size, len(lines) / n, math.log1p(len(raw) / rows), len(set(words)) / n,
        max(Counter(words).values(), default=0) / n, len(set(lines)) / rows, math.log1p(max(map(len, words), default=0)),
        len({tuple(words[i:i + 3]) for i in range(len(words) - 2)}) / max(len(words) - 2, 1),
        sum(w[:1].isupper() for w in words) / n, -sum(p * math.log2(p) for p in shares),
    ]


def isotonic(counts, means):
    """Mean of the best suffix start over the worst prefix end: the min-max form of isotonic regression."""
    n = len(counts)
    mean = lambda a, b: np.average(means[a:b + 1], weights=counts[a:b + 1])
    return [max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)) for k in range(n)]


def test_classifier_equals_plain_numpy(spark, small_dir, texts):
    """Statistics, features, ridge, calibration and scores again, without Spark."""
    docs, marks = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.score for r in quality_classifier.scored(docs, marks).collect()}
    good = {}
    for r in marks.where("quality in (0, 1)").collect():
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in texts:
            good[r.doc_id] = min(r.quality, good.get(r.doc_id, 1))
    ids = sorted(good)
    fold_of = {r.doc_id: r.f for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).alias("f")).collect()}
    x, y = np.array([plain_statistics(texts[i]) for i in ids]), np.array([good[i] for i in ids], float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    s = quality_classifier.Settings()
    rng = np.random.default_rng(s.seed)
    frequencies, phases = rng.normal(0, 1 / s.kernel_width, (x.shape[1], s.features - 1)), rng.uniform(0, 2 * np.pi, s.features - 1)

    def features(rows):
        z = np.clip((rows - mean) / scale, -8, 8)
        return np.hstack([np.sqrt(2 / s.features) * np.cos(z @ frequencies + phases), np.ones((len(rows), 1))])

    held = np.array([fold_of[i] for i in ids])
    z = features(x)
    learn = z[~held]
    gram = learn.T @ learn + s.ridge * len(learn) / s.features * np.eye(s.features)
    weights = np.linalg.solve(gram, learn.T @ y[~held])
    raw = z[held] @ weights
    width = 2.0 / s.bins
    bins = np.clip(np.floor((raw + 0.5) / width), 0, s.bins - 1)
    at = np.array(sorted(set(bins)))
    counts = np.array([(bins == b).sum() for b in at], float)
    means = np.array([y[held][bins == b].mean() for b in at])
    level, knots, heights = isotonic(counts, means), [], []
    for value in sorted(set(np.round(level, 12))):
        own = np.abs(np.array(level) - value) < 1e-9
        n = counts[own].sum()
        knots.append(np.average((at[own] + 0.5) * width - 0.5, weights=counts[own]))
        heights.append((n * value + 0.5) / (n + 1))
    heights = np.maximum.accumulate(heights)
    knots, heights = [-1.5, *knots, 2.5], [heights[0] * 0.5, *heights, 1 - (1 - heights[-1]) * 0.5]
    plain = {i: np.interp(features(np.array([plain_statistics(t)])) @ weights, knots, heights)[0] for i, t in texts.items()}
    far = [i for i in texts if abs(plain[i] - got[i]) > 1e-3]
    # products are summed in units of 2^-32: a value at a bin's edge may fall on its other side
    assert len(far) <= 0.02 * len(texts), [(i, plain[i], got[i]) for i in far[:5]]


def test_scores_of_odd_rows(spark, small_dir):
    marks = spark.read.parquet(f"{small_dir}/labels.parquet")
    real = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = odd_documents(spark).select(F.col("doc_id") + 10_000_000, "text", "lang", "source", F.col("n_chars").cast("long")).toDF(*real.columns)
    got = quality_classifier.scored(real.unionByName(odd.select(*(F.col(c).cast(t).alias(c) for c, t in real.dtypes))), marks)
    scores = {}
    for r in got.where("doc_id is null or doc_id >= 10000000").collect():
        scores.setdefault(r.doc_id, set()).add(r.score)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and (r.doc_id is not None or not r.held_out)
    assert scores[10_000_001] == scores[10_000_002] and len(scores[10_000_004]) == 1  # null like empty, copies alike


def test_empty_tables_everywhere(spark):
    docs = empty_documents(spark)
    for out in (quality_rules.kept_documents(docs, labels(spark)), quality_classifier.kept_documents(docs, labels(spark)),
                line_dedup.deduplicated_documents(docs), near_dedup.one_per_class(docs)):
        assert out.columns == docs.columns and out.collect() == []
    captures = spark.createDataFrame([], "key long, url string, captured_at string, payload string, digest string, bytes int")
    assert warc.archived_history(captures).collect() == []


def test_archives_of_pages_of_all_sizes(spark, monkeypatch):
    """Size classes part the archives; columns with the operator's own names do no harm."""
    monkeypatch.setattr(warc, "SIZE_CLASSES", (100, 1000, 10_000))
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 40)
    sizes = [0, 50, 100, 101, 999, 1000, 5000, 10_000, 30_000, 30_000]
    rows = [(i, f"http://h.org/{i}", "2024-01-01T00:00:00Z", "p" * n, "clash", 7, "clash") for i, n in enumerate(sizes)]
    captures = spark.createDataFrame(rows, "key long, url string, captured_at string, payload string, digest string, bytes int, archive string").repartition(1)
    got = {r.key: r for r in warc.archived_history(captures).collect()}
    assert {k: r.payload_bytes for k, r in got.items()} == dict(enumerate(sizes))
    assert got[9].refers_to == 8 and all(r.record_type == "response" for k, r in got.items() if k != 9)
    assert all(r.payload_digest == hashlib.sha256(b"p" * sizes[k]).hexdigest() for k, r in got.items())


def test_a_text_of_fifty_megabytes(spark):
    text = "\n".join(f"Long text, line {i % 977}: word{i % 211} and more of it." for i in range(1_200_000))
    assert len(text) > 50_000_000
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, text[:1000])], "doc_id long, text string")
    tokens = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in wavelet.written_and_read(docs, BYTE).collect()}
    line = Tokenizer.from_file(BYTE).encode(text[:text.index("\n", 30_000_000)], add_special_tokens=False).ids
    tail = Tokenizer.from_file(BYTE).encode(text[text.index("\n", 30_000_000):], add_special_tokens=False).ids
    whole = np.array(line + tail + [0], "<u4")
    assert tokens[1] == (0, len(whole), zlib.crc32(whole.tobytes())) and tokens[2][0] == len(whole)
    replayed = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in merge_replay.encoded_and_decoded(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert replayed[1] == (len(whole) - 1, hashlib.sha256(text.encode()).hexdigest())
    pieces = packing.packed(docs, WORD).where("doc_id = 1").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).first()
    assert pieces.n == pieces.m > 10_000_000
    assert quality_classifier.scored(docs, labels(spark)).count() == 3


@pytest.mark.parametrize("bad", [[("a", 1)], [("a", None)]])
def test_labels_with_other_columns(spark, bad):
    marks = spark.createDataFrame([(1, q, 0, t) for t, q in bad], "doc_id long, quality int, toxic int, text string")
    docs = odd_documents(spark)
    assert quality_rules.judge(docs, marks).count() == docs.count()
    assert quality_classifier.scored(docs, marks).count() == docs.count()
