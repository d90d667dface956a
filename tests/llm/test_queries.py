"""The registered queries against SQL or brute force on the smallest tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import connect, differences
from tokenizers import Tokenizer

from tallyloom.llm import oracles, queries

QUERIES = queries.queries()


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, small_dir, name):
    difference = differences(QUERIES[name](spark, small_dir), connect(small_dir), oracles.oracle_sql()[name])
    assert difference is None, difference


def test_classifier_on_held_out_labels(spark, small_dir):
    scored = QUERIES["op3_quality_classifier"](spark, small_dir).join(spark.read.parquet(f"{small_dir}/labels.parquet"), "doc_id").toPandas()
    for r in scored.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = scored[scored.held_out]
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9


def near_classes(texts):
    shingles = {}
    for k, t in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", t) if x]
        shingles[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = shingles[a], shingles[b]
            if texts[a] == texts[b] or (x and y and len(x & y) / len(x | y) >= 0.8):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {k: root(k) for k in ids}


def test_near_dedup_against_all_pairs(spark, small_dir, texts):
    got = {r.doc_id: r.class_id for r in QUERIES["op4_near_dedup"](spark, small_dir).collect()}
    assert got == near_classes(texts)


def test_sharding(spark, small_dir, texts):
    rows = QUERIES["op5_sharding"](spark, small_dir).toPandas()
    assert sorted(rows.doc_id) == sorted(texts)
    counts = rows.groupby("shard").size().reindex(range(40), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    for r in rows.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "rows")


def test_token_files(spark, small_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_wavelet"](spark, small_dir).collect()}
    start, want = 0, {}
    for k in sorted(texts):
        ids = tokenizer.encode(texts[k], add_special_tokens=False).ids + [0]
        want[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


def test_merge_replay(spark, small_dir, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op7_merge_replay"](spark, small_dir).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_packing(rows, texts, length=2048, most_padding=0.02):
    """Every id of every text in one piece, no overlap, offsets without gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    total = 0
    assert set(rows.doc_id) == set(texts)
    for k, own in rows.groupby("doc_id"):
        ids, at = np.array(tokenizer.encode(texts[k], add_special_tokens=False).ids + [1], "<u4"), 0
        total += len(ids)
        for r in own.sort_values("start").itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    padding = 0
    for _, own in rows.groupby("sequence_id"):
        end = 0
        for r in own.sort_values("offset").itertuples():
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= length
        padding += length - end if end & (end - 1) else 0
    assert padding <= most_padding * total


def test_packing(spark, small_dir, texts):
    check_packing(QUERIES["op9_packing"](spark, small_dir).toPandas(), texts)
