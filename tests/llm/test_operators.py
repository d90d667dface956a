"""Operators on odd rows, empty tables and their inner parts."""

from __future__ import annotations

import heapq
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import empty_documents, labels, odd_documents, words
from pyspark.sql import functions as F

from tallyloom.llm import (
    line_dedup, merge_replay, near_dedup, packing, quality_classifier, quality_rules, sharding, topk, warc, wavelet,
)

BYTE, RANKS, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))


def operators(spark, docs):
    none = labels(spark)
    yield "rules", quality_rules.judge(docs, none)
    yield "classifier", quality_classifier.scored(docs, none)
    yield "lines", line_dedup.deduplicated(docs)
    yield "near", near_dedup.classes(docs)
    yield "shards", sharding.sharded(docs)
    yield "files", wavelet.written_and_read(docs, BYTE)
    yield "replay", merge_replay.encoded_and_decoded(docs, RANKS, public_tokenizers.PATTERN)


def test_one_row_per_row_of_odd_documents(spark):
    docs = odd_documents(spark)
    n = docs.count()
    for name, out in operators(spark, docs):
        assert out.count() == n, name
    pieces = packing.packed(docs, WORD).toPandas()
    assert pieces[pieces.start == 0].shape[0] == n


def test_empty_tables(spark):
    docs = empty_documents(spark)
    for name, out in operators(spark, docs):
        assert out.count() == 0, name
    assert packing.packed(docs, WORD).count() == 0


def test_stages_keep_the_columns(spark):
    docs = odd_documents(spark)
    for out in (quality_rules.kept_documents(docs, labels(spark)), quality_classifier.kept_documents(docs, labels(spark)),
                line_dedup.deduplicated_documents(docs), near_dedup.one_per_class(docs)):
        assert out.columns == docs.columns
        out.collect()


def test_one_row_of_each_class_stays(spark):
    rows = near_dedup.one_per_class(odd_documents(spark)).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 9]  # 2 is empty like 1
    assert len(rows) == 7


def test_lines_that_go_stand_earlier(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "a\nb"), (4, "a\nb"), (5, "b\nc"), (6, "a\nb\nc\nd")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    assert got == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a\nb", 4: "", 5: "b\nc", 6: ""}
    assert sorted(r.doc_id for r in line_dedup.deduplicated_documents(docs).collect()) == [1, 2, 3, 5]


def test_long_passages_on_one_or_two_lines_go(spark):
    long, half, other, short = (" ".join(words(seed, n)) for seed, n in ((11, 51), (12, 30), (13, 30), (14, 50)))
    rows = [
        (1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, long), (4, f"e\n{half}\n{other}\nf"), (5, f"g\n\n{half}\n \n{other}\nh"),
        (6, f"{half}\n{other}"), (7, f"i\n{half}\nj"), (8, f"k\n{short}\nl"), (9, f"m\n{short}\nn"), (10, f"o\n{long}\n{long}\np")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated_documents(docs).collect()}
    want = dict(rows) | {2: "c\nd", 5: "g\n\n \nh", 10: "o\np"}
    assert got == {k: t for k, t in want.items() if k not in (3, 6)}


def test_binomial_tail(spark):
    from math import comb

    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(x, n) for n in (10, 500) for x in (0, 1, 4)], "x long, n long")
    for r in rows.select("x", "n", quality_rules.binomial_tail(F.col("x"), F.col("n"), 0.05).alias("p")).collect():
        exact = 1.0 if r.x > 0.05 * r.n else sum(comb(r.n, i) * 0.05**i * 0.95 ** (r.n - i) for i in range(r.x + 1))
        assert abs(r.p - exact) < 1e-9


def test_loser_tree_merges_like_a_heap():
    rng = random.Random(3)
    runs = [sorted((rng.randint(0, 50), r, i) for i in range(rng.randint(0, 40))) for r in range(9)]
    blocks = [(run[i], r, [(k, k) for k in run[i:i + 4]]) for r, run in enumerate(runs) for i in range(0, len(run), 4)]
    assert list(warc.merged(iter(sorted(blocks, key=lambda b: b[0])))) == list(heapq.merge(*runs))


def test_capture_history_of_odd_captures(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 3)
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 2)
    big = "WARC/1.1\r\n\r\n" * 20
    rows = [(3, "http://b.org/x\r\ny", "t", big), (1, None, "t", big), (2, "https://a.b.org/", "t", None), (None, "http://b.org/", "t", big),
            (5, "http://b.org/", "t", "short"), (6, "http://b.org/", "t", "short")]
    got = warc.archived_history(spark.createDataFrame(rows, "key long, url string, captured_at string, payload string")).collect()
    by_key = {r.key: r for r in got}
    assert sorted(r.position for r in got) == list(range(6))
    assert [r.url_key for r in sorted(got, key=lambda r: r.position)] == sorted(r.url_key for r in got)
    assert {k: (r.record_type, r.refers_to) for k, r in by_key.items()} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 5: ("response", None), 6: ("response", None)}
    assert by_key[3].payload_bytes == len(big) and by_key[2].payload_bytes == 0


def test_dart_signatures_estimate_weighted_similarity():
    text = np.repeat([0, 1], 60)
    element = near_dedup.mixed(np.concatenate([np.arange(60), np.arange(20, 80)]).astype(np.uint64))
    weight = np.concatenate([np.full(60, 2.5), np.full(60, 1.5)])
    for w, want in ((None, 40 / 80), (weight, 40 * 1.5 / (60 * 2.5 + 20 * 1.5))):
        a, b = near_dedup.signatures(text, element, 2, w, hashes=2000)
        assert abs(np.mean(a == b) - want) < 0.05


def test_parities_bound_the_difference_of_two_sets():
    rng = np.random.default_rng(3)
    for size, changed in ((40, 0), (40, 5), (300, 60), (4000, 900)):
        one = near_dedup.mixed(np.arange(size).astype(np.uint64))
        other = one.copy()
        other[rng.permutation(size)[:changed]] = rng.integers(0, 1 << 63, changed).astype(np.uint64)
        text, element = np.repeat([0, 1], size), np.concatenate([one, other])
        cells = near_dedup.shingle_parities(text, element, 3)
        apart = sum(int(x).bit_count() for x in (cells[0] ^ cells[1]).view(np.uint64))
        assert apart <= 2 * changed
        assert changed == 0 or apart > 0
        assert not cells[2].any()


def test_classes_merge_over_further_links(spark):
    first = near_dedup.components(spark.createDataFrame([(1, 2), (2, 3), (5, 6), (8, 9)], "a long, b long"))
    after = near_dedup._relabelled(first, spark.createDataFrame([(3, 6), (9, 10), (11, 12)], "a long, b long"))
    assert sorted(map(tuple, after.collect())) == [
        (1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (8, 8), (9, 8), (10, 8), (11, 11), (12, 11)]


def test_a_family_of_copies_loses_no_link(spark):
    """Copies of one text, each with a changed part: classes as all pairs give them."""
    from test_queries import near_classes

    base, rng, texts = words(1, 120), random.Random(2), {}
    for k in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(120)] = f"w{k}x{rng.randrange(999)}"
        texts[k] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()} == near_classes(texts)


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 300, 3000).astype(np.uint32)
    shard = wavelet.WaveletMatrix(wavelet.build(2, 7, [1, None], [1000, 2000], ids))
    assert shard.ids().tolist() == ids.tolist() and shard.doc_ids == [1, None]
    for i in (0, 511, 512, 2999):
        assert shard.access(i) == ids[i]
    for token in (0, 17, 299):
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places) and shard.count(token, 1500) == int((places < 1500).sum())
        assert [shard.occurrence(token, k) for k in range(len(places))] == places.tolist()
    assert shard.count(5000) == 0


def test_replay_equals_plain_merging():
    merges = merge_replay.Merges(RANKS)
    found = [b"", b"a", b"aaaaaaa", b"abababab", " thereof".encode(), "日本語".encode()] + [w.encode() for w in words(3, 300)]
    ids, counts = merge_replay.replay(found, merges)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for word, own in zip(found, parts):
        assert own.tolist() == ([merges.ranks[word]] if word in merges.ranks else merges.one_word(word))


def test_column_generation_and_plan():
    rng = np.random.default_rng(2)
    demand = np.bincount(rng.integers(1, 65, 5000), minlength=65)[1:]
    plan = packing.planned(demand, 64)
    used = np.zeros(64, int)
    for uses, items in plan.patterns:
        assert sum(size * times for size, times in items) <= 64
        for size, times in items:
            used[size - 1] += uses * times
    assert (used <= demand).all() and used.sum() > 0.8 * demand.sum()


def test_short_texts_are_packed_without_padding(spark):
    from test_queries import check_packing

    for most_words, n in ((1, 3000), (12, 1500)):
        rng, vocabulary = random.Random(n), words(4, 300)
        texts = {i: " ".join(rng.choices(vocabulary, k=rng.randint(1, most_words))) for i in range(n)}
        rows = packing.packed(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), WORD).toPandas()
        check_packing(rows, texts)
        filled = rows.groupby("sequence_id").length.sum()
        assert filled[filled >= 0.99 * 2048].sum() > filled.sum() - 2048


def test_top_scores_of_odd_vectors(spark):
    rows = [(0, [1.0, -0.5]), (50, [0.5]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (None, [1.0, 1.0]), (2, [1.0, 2.0]), (6, [-1.0, 0.0])]
    got = topk.highest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == [
        (0, 1, 50, 32768), (0, 2, 1, 0), (0, 3, 2, 0), (50, 1, 0, 32768), (50, 2, 1, 32768), (50, 3, 2, 32768)]


def test_sharding_keeps_groups_and_splits_the_largest(spark):
    rows = [(i, "same") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(200)] + [(2000 + i, f"own {i}") for i in range(500)]
    out = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), sharding.Settings(shards=10)).toPandas()
    assert set(out.groupby("shard").size()) == {100}
    pairs = out[(out.doc_id >= 1000) & (out.doc_id < 2000)].assign(group=lambda d: (d.doc_id - 1000) // 2)
    assert (pairs.groupby("group").shard.nunique() > 1).sum() <= 5


def _cut_groups(spark, sizes, shards):
    rows = [(1000 * g + i, f"group {g}") for g, n in enumerate(sizes) for i in range(n)]
    out = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), sharding.Settings(shards=shards)).toPandas()
    assert sorted(out.doc_id) == sorted(i for i, _ in rows)
    counts = out.groupby("shard").size().reindex(range(shards), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, own in out.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    spread = out.groupby(out.doc_id // 1000).shard.nunique()
    return int((spread > 1).sum()), int(spread.max())


def test_sharding_of_texts_that_all_have_a_copy(spark):
    assert _cut_groups(spark, [2] * 1000, 10) == (0, 1)
    assert _cut_groups(spark, [5] * 400, 10)[0] == 0
    assert _cut_groups(spark, [2, 3] * 200, 7)[0] <= 6
    assert _cut_groups(spark, [3] * 200 + [1] * 40, 8)[0] == 0
    cut, most = _cut_groups(spark, [450, 130, 130, 90, *[2] * 600], 10)  # shards of 200: the largest needs three
    assert cut <= 10 and most == 3


def test_isotonic_blocks_rise():
    blocks = quality_classifier.pooled(np.ones(6), np.array([0.1, 0.4, 0.2, 0.2, 0.9, 0.8]))
    assert [round(m, 6) for _, m, _, _ in blocks] == [0.1, 0.266667, 0.85]


def test_granted_flows_leave_no_shard_overfull():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randint(2, 6)
        room = [rng.randint(0, 30) for _ in range(n)]
        load = [rng.randint(0, r) for r in room]
        wishes = {(a, b): rng.randint(1, 20) for a in range(n) for b in range(n) if a != b and rng.random() < 0.6}
        wishes = {k: min(v, load[k[0]]) for k, v in wishes.items() if load[k[0]]}
        given = sharding.granted(wishes, load, room)
        for s in range(n):
            out, into = (sum(v for k, v in given.items() if k[i] == s) for i in (0, 1))
            assert load[s] + into - out <= room[s] or not into
        assert all(0 < v <= wishes[k] for k, v in given.items())
    assert sharding.granted({(0, 1): 5, (1, 0): 5}, [9, 9], [9, 9]) == {(0, 1): 5, (1, 0): 5}  # a full swap


def test_labels_travel_from_hub_to_hub(spark):
    """Chains of hubs that share documents, started at random: cut edges fall from round to round."""
    rng, links = random.Random(5), []
    for chain in range(30):
        for hub in range(8):
            members = [f"{chain}-{hub}-{i}" for i in range(6)] + [f"{chain}-{hub}-shared", f"{chain}-{hub + 1}-shared"]
            links += [(m, f"{chain}/{hub}") for m in members]
    nodes = {name: i for i, name in enumerate(sorted({m for m, _ in links}))}
    frame = spark.createDataFrame([(nodes[m], h) for m, h in links], "node long, hub string")
    start = spark.createDataFrame([(i, rng.randrange(4)) for i in nodes.values()], "node long, shard int")
    room = [len(nodes) // 4 + 120] * 4
    found = sharding.propagated(frame, start, room, 12)
    cut = found.cut_edges
    assert all(b <= a for a, b in zip(cut, cut[1:])) and cut[-1] < cut[0] / 4
    load = found.labels.groupBy("shard").count().collect()
    assert sum(r["count"] for r in load) == len(nodes) and max(r["count"] for r in load) <= room[0] + 60
    # node 5 is in no hub with a document of shard 0, but its neighbours come to be there
    links = [(n, h) for h, own in {"x": (1, 2, 3), "y": (2, 3, 6, 4, 7), "z": (4, 7, 5)}.items() for n in own]
    start = [(1, 0), (2, 0), (3, 0), (6, 0), (4, 1), (7, 1), (5, 2)]
    found = sharding.propagated(
        spark.createDataFrame(links, "node long, hub string"), spark.createDataFrame(start, "node long, shard int"), [9, 9, 9], 9)
    assert {r.node: r.shard for r in found.labels.collect()} == {n: 0 for n, _ in start}
    assert found.cut_edges[-1] == 0 and len(found.cut_edges) == 3


def test_propagation_without_links_or_room(spark):
    nothing = spark.createDataFrame([], "node long, hub string")
    found = sharding.propagated(nothing, spark.createDataFrame([], "node long, shard int"), [1, 1], 3)
    assert found.cut_edges == [0] and found.labels.collect() == []
    links = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "b")], "node long, hub string")
    start = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 1)], "node long, shard int")
    found = sharding.propagated(links, start, [2, 2], 3)
    assert found.cut_edges[0] == 2


def test_granted_flows_gain_most():
    """Against all flows of small cases."""
    rng = random.Random(11)
    for _ in range(60):
        n = rng.randint(2, 3)
        room = [rng.randint(0, 6) for _ in range(n)]
        load = [rng.randint(0, r) for r in room]
        keys = [(a, b, c) for a in range(n) for b in range(n) if a != b and load[a] for c in (1, 2) if rng.random() < 0.6][:5]
        wishes, gain = {k: rng.randint(1, 3) for k in keys}, {k: rng.randint(1, 9) for k in keys}
        best = 0
        for flow in itertools.product(*(range(wishes[k] + 1) for k in keys)):
            held = load[:]
            for (a, b, _), x in zip(keys, flow):
                held[a] -= x
                held[b] += x
            if all(h <= r for h, r in zip(held, room)):
                best = max(best, sum(gain[k] * x for k, x in zip(keys, flow)))
        given = sharding.granted(wishes, load, room, gain)
        assert sum(gain[k] * x for k, x in given.items()) == best


def test_propagation_brings_copies_together(spark):
    """Copies start apart, the rounds unite them, and no group is left cut though every shard is full."""
    rows = spark.createDataFrame([(i, f"text {i // 4}") for i in range(800)], "doc_id long, text string")
    nodes = sharding.stored(sharding.nodes(rows).withColumn("node", F.monotonically_increasing_id()), "nodes")
    seen, real = [], sharding.propagated
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sharding, "propagated", lambda *a: seen.append(real(*a)) or seen[-1])
        out = sharding.sharded(rows, sharding.Settings(shards=5)).toPandas()
    cut = seen[0].cut_edges
    assert cut[0] > 800 and cut[-1] < cut[0] / 8  # 1,200 edges; laid hub after hub, none was cut
    assert (out.groupby(out.doc_id // 4).shard.nunique() == 1).all() and set(out.groupby("shard").size()) == {160}
    start = sharding.started(nodes, ["hub"], [160] * 5)
    assert real(nodes, start, [160] * 5, 3).cut_edges[0] < 20
