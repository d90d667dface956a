"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification.

Darts: every element (a distinct shingle of five words, weight 1; other weights are possible) owns a strip of
the plane of weight and rank. Hashes throw darts into the cells of that strip, a Poisson number per cell, each
with a rank and one of ``HASHES`` coordinates. A set throws only up to the rank at which all coordinates are
expected to be hit, and further for those that are not; each coordinate keeps its earliest dart. Two sets agree
in a coordinate with the probability of their weighted Jaccard similarity.

Joining: signatures are cut into bands of ``ROWS`` darts. Texts that share a band form a bucket; two texts of
similarity 0.8 meet with a probability above 1 - 2e-5, more similar ones rather. In each bucket all texts are
compared with a leader (the text with the largest buckets altogether, mostly the original of the copies);
exact Jaccard similarity over the whole shingle sets decides. Buckets whose texts are then in different
classes are worked off with further leaders, round by round, until every pair of a bucket is either in one
class or was compared. So no link among the texts of a bucket is lost, and no bucket is expanded into all
its pairs. Classes are connected components, found by label propagation with shortcuts.

Before a pair leaves a bucket it passes an exact filter: every text carries the parities of its shingles in
``PARITIES`` cells. Two sets differ in at least as many shingles as their parities differ in cells, so a pair
whose parities differ more than a similarity of ``SIMILARITY`` allows has no link and need not be verified.

Exact copies are one text from the start. Every table between the steps is stored in the shared folder.

Defined results: equal texts share a class, also the empty ones and null, which counts as empty; texts with
one to four words have one shingle, all their words; texts without words are like equal texts only. A class is
known by its smallest doc_id; rows without id take part, and a class of such rows only has a null class id.
Repeated rows are copies. Texts of any length are compared whole. Columns besides doc_id and text are passed on or left
out, not read. An empty table gives an empty result. Similarity is that of shingle sets, so all darts have weight 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import small_batches, stored, text_or_empty

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
LEADERS = 16  # leaders per bucket in the second round; four times as many in each further one
PARITIES = 1024
SEGMENT = 1 << 20  # bytes whose words are hashed at a time

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse_odd(a: int) -> int:
    return pow(a, -1, 1 << 64)


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte position of every word of ``raw`` (UTF-8); no word reaches over one of the ``starts``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D. Polynomial prefix sums modulo 2^64 give all of a
    segment at once.
    """
    hashes, places = [], []
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    head = np.ones(len(raw), bool)
    head[1:] = space[:-1]
    head[starts[starts < len(raw)]] = True
    head &= ~space
    tail = np.ones(len(raw) + 1, bool)
    tail[:-1] = space | head
    begins = np.flatnonzero(head)
    if not len(begins):
        return np.zeros(0, np.uint64), begins
    ends_at = np.flatnonzero(tail)
    ends = ends_at[np.searchsorted(ends_at, begins, side="right")]
    base, back = 0xD6E8FEB86659FD93, _inverse_odd(0xD6E8FEB86659FD93)
    first = 0
    while first < len(begins):
        low = begins[first]
        last = max(first + 1, int(np.searchsorted(ends, low + SEGMENT, side="right")))
        high = ends[last - 1]
        n = int(high - low)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, back, np.uint64)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        a, b = begins[first:last] - low, ends[first:last] - low
        hashes.append(mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _ODD))
        places.append(begins[first:last])
        first = last
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(raw: np.ndarray, starts: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), distinct and sorted, of the texts that begin at ``starts`` in ``raw``."""
    hashes, places = word_hashes(raw, starts)
    owner = np.searchsorted(starts, places, side="right") - 1
    counts = np.bincount(owner, minlength=len(starts)) if len(owner) else np.zeros(len(starts), np.int64)
    first = np.cumsum(counts) - counts
    n = len(hashes)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = mixed(rolled * _ODD + hashes[k:n - width + 1 + k]) if len(rolled) else rolled
    whole = owner[:len(rolled)] == owner[width - 1:] if len(rolled) else np.zeros(0, bool)
    texts, values = [owner[:len(rolled)][whole]], [rolled[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < width)).tolist():
        value = np.uint64(counts[i])
        for h in hashes[first[i]:first[i] + counts[i]]:
            value = mixed(np.array([value], np.uint64) * _ODD + h)[0]
        texts.append(np.array([i]))
        values.append(np.array([value], np.uint64))
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def _poisson_steps(mean: float) -> np.ndarray:
    """Distribution function of a Poisson variable, as thresholds for a uniform number."""
    terms, p, k = [], np.exp(-mean), 0
    while True:
        terms.append(p)
        if k > mean and p < 1e-18:
            return np.cumsum(terms)
        k += 1
        p *= mean / k


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) * 2.0 ** -53


def signatures(text: np.ndarray, element: np.ndarray, texts: int, weight: np.ndarray | None = None, hashes: int = HASHES) -> np.ndarray:
    """Earliest dart of each coordinate: a matrix of dart hashes, one row per text (0 in rows without element).

    ``text`` and ``element``: the elements of all texts. Elements have weight 1 unless ``weight`` is given; a
    strip is made of cells of height 1, and of the topmost cell only the darts below the weight count.
    """
    out = np.zeros((texts, hashes), np.uint64)
    best = np.full((texts, hashes), np.inf)
    if weight is not None:  # one row per cell of the strip, the last one cut at the weight
        cells = np.ceil(weight).astype(np.int64)
        text, height = np.repeat(text, cells), np.repeat(weight, cells)
        number = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        element = mixed(np.repeat(element, cells) + number.astype(np.uint64) * _ODD)
        height = np.minimum(height - number, 1.0)
    else:
        height = None
    total = np.bincount(text, weights=height, minlength=texts)
    # expected darts up to the limit: enough for every coordinate to be hit, but for a small chance
    level = np.full(texts, -100)
    full = total > 0
    level[full] = np.ceil(np.log2((hashes * np.log(hashes) + 2 * hashes) / total[full])).astype(int)
    lowest = -6
    done = np.full(texts, lowest - 1)
    level[full] = np.maximum(level[full], lowest)
    open_texts = full.copy()
    while open_texts.any():
        for step in range(lowest, int(level[open_texts].max()) + 1):
            # ranks of this step: [0, 2^lowest) first, then [2^(step-1), 2^step)
            wanted = open_texts & (level >= step) & (done < step)
            rows = np.flatnonzero(wanted[text])
            if not len(rows):
                continue
            low, high = (0.0, 2.0 ** lowest) if step == lowest else (2.0 ** (step - 1), 2.0 ** step)
            seed = mixed(element[rows] ^ mixed(np.array([step + 1000], np.uint64)))
            steps = _poisson_steps(high - low)
            count = np.searchsorted(steps, _uniform(seed), side="right")
            hit = np.flatnonzero(count)
            count = count[hit]
            at = np.repeat(hit, count)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            dart = mixed(seed[at] + (nth + 1).astype(np.uint64) * _ODD)
            rank = low + (high - low) * _uniform(mixed(dart ^ np.uint64(1)))
            column = (mixed(dart ^ np.uint64(2)) % np.uint64(hashes)).astype(np.int64)
            owner = text[rows[at]]
            if height is not None:
                below = _uniform(mixed(dart ^ np.uint64(3))) < height[rows[at]]
                dart, rank, column, owner = dart[below], rank[below], column[below], owner[below]
            place = owner * hashes + column
            order = np.lexsort((rank, place))
            place, rank, dart = place[order], rank[order], dart[order]
            new = np.ones(len(place), bool)
            new[1:] = place[1:] != place[:-1]
            place, rank, dart = place[new], rank[new], dart[new]
            earlier = rank < best.ravel()[place]
            best.ravel()[place[earlier]] = rank[earlier]
            out.ravel()[place[earlier]] = dart[earlier]
            done[wanted] = step
        # darts beyond the limit are later than all within it: only coordinates not hit need more
        open_texts &= np.isinf(best).any(axis=1)
        level[open_texts] += 1
    return out


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit hash per band, which the number of the band is part of."""
    parts = signature.reshape(len(signature), bands, -1)
    value = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * _ODD), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        value = mixed(value * _ODD + parts[:, :, k])
    return value


def shingle_parities(text: np.ndarray, element: np.ndarray, texts: int) -> np.ndarray:
    """Per text, whether each of ``PARITIES`` cells holds an odd number of its elements, 64 cells in a number."""
    cell = text * PARITIES + (element % np.uint64(PARITIES)).astype(np.int64)
    odd = (np.bincount(cell, minlength=texts * PARITIES) & 1).astype(np.uint8).reshape(texts, PARITIES)
    return np.packbits(odd, axis=1).view(np.int64)


def _may_be_similar(x: str, y: str, x_size: str, y_size: str, similarity: float) -> Column:
    """False only for pairs whose parities prove a lower similarity."""
    apart = sum(F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(PARITIES // 64))
    return apart * (1 + similarity) <= (F.col(x_size) + F.col(y_size)) * (1 - similarity) + 1e-6


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last, bytes, starts) of consecutive texts of about ``SEGMENT`` bytes together."""
    array = batch.column(column)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if pa.types.is_large_string(array.type) else np.int32)
    offsets = offsets[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, side="right")) - 1)
        yield first, last, raw[offsets[first]:offsets[last]], offsets[first:last] - offsets[first]
        first = last


def _hash() -> Column:
    return F.unhex(F.md5(text_or_empty()))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(id, text_hash, first_id, shingles, bands, parities) of each distinct text, stored; ``id`` is a number for joins."""
    spark = docs.sparkSession
    small_batches(spark)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, starts in _texts(batch, 2):
                owner, value = shingle_sets(raw, starts)
                sizes = np.bincount(owner, minlength=b - a) if len(owner) else np.zeros(b - a, np.int64)
                found = band_hashes(signatures(owner, value, b - a)).view(np.int64)
                bands = [row if n else [] for row, n in zip(found, sizes)]
                parities = shingle_parities(owner, value, b - a)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[a:b], batch.column(1)[a:b], pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                    pa.array(list(parities), pa.list_(pa.int64())),
                ], names=["doc_id", "text_hash", "shingles", "bands", "parities"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _hash().alias("text_hash"), text_or_empty().alias("text"))
    signed = rows.mapInArrow(sign, "doc_id long, text_hash binary, shingles long, bands array<long>, parities array<long>")
    distinct = signed.groupBy("text_hash").agg(
        F.min("doc_id").alias("first_id"), F.first("shingles").alias("shingles"), F.first("bands").alias("bands"),
        F.first("parities").alias("parities"))
    return stored(distinct.withColumn("id", F.monotonically_increasing_id()), "signatures")


def _buckets(texts: DataFrame) -> DataFrame:
    """(bucket, id, shingles, weight) of the texts that share a band; weight: sum of the text's bucket sizes."""
    rows = texts.select("id", "shingles", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(rows.join(shared, "bucket"), "buckets")
    weights = members.groupBy("id").agg(F.sum("size").alias("weight"))
    return stored(members.join(weights, "id").select("bucket", "id", "shingles", "weight"), "weighted-buckets")


def _shingles(docs: DataFrame, texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, set array<long>) of the texts named by ``ids``."""
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, starts in _texts(batch, 1):
                owner, value = shingle_sets(raw, starts)
                ends = np.searchsorted(owner, np.arange(b - a), side="right")
                sets = [part.view(np.int64) for part in np.split(value, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    wanted = texts.join(ids, "id", "left_semi").select("id", "text_hash")
    rows = docs.select(_hash().alias("text_hash"), text_or_empty().alias("text")).join(wanted, "text_hash")
    small_batches(spark)
    one = rows.select("id", "text").mapInArrow(cut, "id long, set array<long>")
    return stored(one.groupBy("id").agg(F.first("set").alias("set")), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least this Jaccard similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    union = F.size("left") + F.size("right") - F.col("common")
    return joined.where(F.col("common") / union >= similarity).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id of each connected component of the links (a, b); stored.

    Each round takes the smallest label of a node and its neighbours, then the label of that label.
    """
    links = stored(links, "links")
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    labels = stored(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("other"), F.col("label").alias("near")), "other")
        least = seen.groupBy("id").agg(F.min("near").alias("near"))
        lower = labels.join(least, "id").select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("beyond"))
        moved = stored(lower.join(jump, "low").select("id", F.col("label").alias("old"), F.least("low", "beyond").alias("label")), "labels")
        changed = moved.where("old <> label").limit(1).count()
        labels = moved.select("id", "label")
        if not changed:
            return labels


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: components of the labels that the links connect."""
    of_a = labels.select(F.col("id").alias("a"), F.col("label").alias("x"))
    of_b = labels.select(F.col("id").alias("b"), F.col("label").alias("y"))
    named = links.join(of_a, "a", "left").join(of_b, "b", "left")
    over = components(named.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")))
    moved = labels.join(over.select(F.col("id").alias("label"), F.col("label").alias("new")), "label", "left").select(
        "id", F.coalesce("new", "label").alias("label"))
    return stored(moved.unionByName(over.join(labels, "id", "left_anti")), "labels")


def _labels(docs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame | None:
    """(id, label) of all texts with a link; None if no two texts share a band.

    Ends when no pair of a bucket is both in two classes and unchecked.
    """
    members = _buckets(texts)
    if members.isEmpty():
        return None
    close = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)  # noqa: E731  sizes of similar sets
    leaders = members.groupBy("bucket").agg(
        F.max_by(F.struct("id", "shingles"), F.struct("weight", -F.col("id"))).alias("leader"))
    led = stored(members.join(leaders, "bucket").where(F.col("id") != F.col("leader.id")), "led")
    pairs = led.where(close(F.col("shingles"), F.col("leader.shingles"))).select(
        F.least("id", F.col("leader.id")).alias("a"), F.greatest("id", F.col("leader.id")).alias("b")).distinct()
    tested = stored(pairs, "pairs")
    sets = _shingles(docs, texts, members.select("id").distinct())
    labels = components(_verified(tested, sets, similarity))
    waiting, most = led.select("bucket", "id", "shingles", "weight"), LEADERS
    parities = texts.select("id", "parities")
    while True:
        named = waiting.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        # a bucket is done when those that have not led yet are of one class
        split = named.groupBy("bucket").agg(F.min("label").alias("_x"), F.max("label").alias("_y")).where("_x <> _y").select("bucket")
        order = Window.partitionBy("bucket").orderBy(F.desc("weight"), "id")
        left = named.join(split, "bucket").join(parities, "id") if "parities" not in named.columns else named.join(split, "bucket")
        waiting = stored(left.withColumn("turn", F.row_number().over(order)), "waiting")
        if waiting.isEmpty():
            return labels
        leading = waiting.where(F.col("turn") <= most).select(
            "bucket", F.col("id").alias("lead"), F.col("label").alias("lead_label"), F.col("shingles").alias("lead_shingles"), F.col("parities").alias("lead_parities"))
        found = waiting.join(leading, "bucket").where("label <> lead_label").where(
            close(F.col("shingles"), F.col("lead_shingles"))).where(
            _may_be_similar("parities", "lead_parities", "shingles", "lead_shingles", similarity))
        fresh = stored(found.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct().join(
            tested, ["a", "b"], "left_anti"), "pairs")
        links = stored(_verified(fresh, sets, similarity), "links")
        if not links.isEmpty():
            labels = _relabelled(labels, links)
        tested = tested.unionByName(fresh)
        waiting, most = waiting.where(F.col("turn") > most).drop("label", "turn"), 4 * most


def text_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(text_hash, class_id, first_hash): class of each distinct text, and the text that stands for the class."""
    texts = distinct_texts(docs)
    labels = _labels(docs, texts, similarity)
    nodes = texts.select("id", "text_hash", "first_id")
    if labels is None:
        return nodes.select("text_hash", F.col("first_id").alias("class_id"), F.col("text_hash").alias("first_hash"))
    labelled = nodes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    order = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "text_hash")
    classes = labelled.groupBy("label").agg(F.min("first_id").alias("class_id"), F.min_by("text_hash", order).alias("first_hash"))
    return labelled.join(classes, "label").select("text_hash", "class_id", "first_hash")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id and class_id, the smallest doc_id of its class."""
    rows = docs.select("doc_id", _hash().alias("text_hash"))
    return rows.join(text_classes(docs, similarity).select("text_hash", "class_id"), "text_hash").select("doc_id", "class_id")


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The row with the smallest doc_id of each class, with all columns (rows without id after the others)."""
    chosen = stored(text_classes(docs, similarity), "text-classes").where("text_hash = first_hash").select(
        "text_hash", F.col("class_id").alias("_class"))
    rows = docs.select(F.struct("*").alias("row"), _hash().alias("text_hash"))
    first = rows.join(chosen, "text_hash").where(F.col("row.doc_id").eqNullSafe(F.col("_class")))
    # rows equal in id and text: one of them; only ids that repeat are shuffled with their rows
    keys = docs.select("doc_id", _hash().alias("text_hash")).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    keys = stored(keys.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "repeated-rows")
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    if keys.isEmpty():
        return first.select("row.*")
    single = first.join(keys, same, "left_anti").select("row")
    repeated = first.join(keys, same, "left_semi").groupBy("row.doc_id", "text_hash").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(repeated).select("row.*")
