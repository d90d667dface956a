"""Packing of token sequences by cutting-stock column generation.

Documents are cut into full sequences; what is left of each (its remainder) is an item. The items' length
histogram, in classes of ``CLASS`` tokens, is the demand of a cutting-stock problem: a linear program over
patterns (how many items of each class share a sequence). A knapsack dynamic programme prices new patterns
with the duals until none improves the bound by more than ``TOLERANCE``. Rounded down, patterns are given to
documents by their rank inside their class, the longest first, as often as their real lengths fill every such
sequence nearly. Items that no pattern takes (rounding, poor fits) are
laid end to end and cut at the sequence length, so they need no padding at all; the last, incomplete sequence
is cut at powers of two.

The driver sees the histogram only (one number per length), and its work does not grow with the input.
Documents are tokenized once: the ids of remainders (fewer than a sequence has) are stored, and what is cut inside
one takes its checksum from them.

Defined results: null text is empty and consists of the end id; rows equal in id and text are packed
separately, and of equal lengths the smaller id comes first; long texts are cut like others, whole; columns besides
doc_id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import numbered, small_batches, stored, text_or_empty
from tallyloom.llm.tokens import blocks, library_encoder

CLASS = 8
TOLERANCE = 0.002
MAX_COLUMNS = 1000
ROUNDINGS = 2
SMOOTHING = 0.7
WORST_FILL = 0.99  # a pattern that fills less, in classes or in tokens, is left to the end-to-end part


@dataclass(frozen=True)
class Plan:
    """Patterns: (uses, ((class, items), ...)), classes descending."""

    patterns: list[tuple[int, tuple[tuple[int, int], ...]]]


def _knapsack(values: np.ndarray, capacity: int) -> np.ndarray:
    """Items of each size (index + 1) that maximise the value within ``capacity``."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        options = best[c - 1::-1][:len(values)] + values[:c]  # size s + 1 leaves c - s - 1
        top = int(np.argmax(options))
        if options[top] > best[c - 1] + 1e-12:
            best[c], choice[c] = options[top], top + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(values), np.int64), capacity
    while c > 0:
        if choice[c]:
            counts[choice[c] - 1] += 1
            c -= choice[c]
        else:
            c -= 1
    return counts


def column_generation(demand: np.ndarray, capacity: int) -> list[tuple[float, np.ndarray]]:
    """Fractional solution of the cutting-stock LP: (uses, items per class); class k has size k + 1.

    Revised simplex from the patterns of one class each; the knapsack programme finds the entering pattern,
    and its value bounds the optimum, so the search can stop close to it. Rounding errors of the inverse can
    only cost quality: the plan takes whole patterns, and no more than there are items.
    """
    classes = np.flatnonzero(demand)
    rows = len(classes)
    if not rows:
        return []
    basis = np.zeros((rows, rows))
    np.fill_diagonal(basis, capacity // (classes + 1))
    inverse = np.diag(1 / np.diag(basis))
    level = inverse @ demand[classes].astype(float)
    columns = [basis[:, i].copy() for i in range(rows)]
    for _ in range(MAX_COLUMNS):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        for share in (SMOOTHING, 0.0):  # prices drawn to the sizes' own shares first: they settle sooner
            values = np.zeros(len(demand))
            values[classes] = np.maximum(share * (classes + 1) / capacity + (1 - share) * duals, 0)
            entering = _knapsack(values, capacity)[classes].astype(float)
            gain = float(duals @ entering)
            if gain > 1 + TOLERANCE:
                break
        else:
            break
        direction = inverse @ entering
        up = direction > 1e-9
        if not up.any():
            break
        ratios = np.full(rows, np.inf)
        ratios[up] = np.maximum(level[up], 0) / direction[up]
        out = int(np.argmin(ratios))
        step = ratios[out]
        level = level - step * direction
        level[out] = step
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
        columns[out] = entering
    solution = []
    for uses, column in zip(level, columns):
        whole = np.zeros(len(demand), np.int64)
        whole[classes] = np.rint(column).astype(np.int64)
        solution.append((float(uses), whole))
    return solution


def least_fill(lengths: np.ndarray, taken: np.ndarray, items: np.ndarray, uses: int) -> int:
    """Tokens of the poorest of ``uses`` sequences of a pattern with ``items`` of each class.

    ``lengths[n]`` items have n tokens; inside a class the longest come first, and ``taken`` of them are used.
    """
    tokens = 0
    for k in np.flatnonzero(items):
        longest = (k + 1) * CLASS
        upto = np.cumsum(lengths[longest:longest - CLASS:-1])  # items of the longest, second longest ... length
        last = taken[k] + uses * np.arange(1, items[k] + 1) - 1  # the last sequence has the shortest item of each slot
        tokens += int((longest - np.searchsorted(upto, last, side="right")).sum())
    return tokens


def planned(demand: np.ndarray, capacity: int, poorest: Callable[[np.ndarray, np.ndarray, int], float] | None = None) -> Plan:
    """Rounded patterns; ``demand[k]`` items have class k + 1, whose size is k + 1 units of ``capacity``.

    ``poorest(taken, items, uses)`` is the share of a sequence that such a pattern really fills, at least; more uses
    never fill better.
    """
    left = demand.copy()
    sizes = np.arange(1, len(demand) + 1)
    chosen = []
    for _ in range(ROUNDINGS):  # what rounding and poor patterns leave is solved for once more
        solution = sorted(column_generation(left, capacity), key=lambda s: (-int(s[1] @ sizes), -s[0], s[1].tolist()))
        for uses, items in solution:
            if items @ sizes < WORST_FILL * capacity:
                continue
            inside = items > 0
            times = min(int(uses + 1e-6), int((left[inside] // items[inside]).min()))
            few = 0 if poorest is not None else times
            while few < times:  # the most uses that are full enough
                middle = (few + times + 1) // 2
                if poorest(demand - left, items, middle) >= WORST_FILL:
                    few = middle
                else:
                    times = middle - 1
            if times > 0:
                left -= times * items
                chosen.append((times, tuple((int(k) + 1, int(items[k])) for k in np.flatnonzero(items)[::-1])))
    return Plan(chosen)


def measured(docs: DataFrame, vocabulary: str, end_id: int, length: int) -> DataFrame:
    """(doc_id, n, full_crcs, rest_crc, rest_ids) per row: checksums of its full sequences, and its remainder."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in blocks(texts):
                ids, counts = encoder.encode(texts[part])
                full, rest, end = [], [], 0
                for n in counts.tolist():
                    raw = np.append(ids[end:end + n], end_id).astype("<u4").tobytes()
                    end += n
                    cuts = range(0, (n + 1) // length * length * 4, 4 * length)
                    full.append([zlib.crc32(raw[a:a + 4 * length]) for a in cuts])
                    rest.append(raw[4 * length * len(cuts):])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[part.start:part.stop], pa.array(counts + 1, pa.int64()), pa.array(full, pa.list_(pa.int64())),
                    pa.array([zlib.crc32(r) for r in rest], pa.int64()), pa.array(rest, pa.binary()),
                ], names=["doc_id", "n", "full_crcs", "rest_crc", "rest_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, full_crcs array<long>, rest_crc long, rest_ids binary")


def _tail_cuts(total: int, length: int) -> list[int]:
    """Ends of the sequences of the last, incomplete stretch of ``total`` tokens laid end to end."""
    at, rest = total // length * length, total % length
    cuts = []
    while rest:
        step = 1 << (rest.bit_length() - 1)
        at, rest = at + step, rest - step
        cuts.append(at)
    return cuts


def packed(docs: DataFrame, vocabulary: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces of all ``docs``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences are numbered from 0: patterns, then end-to-end sequences, then full cuts of long documents.
    """
    spark = docs.sparkSession
    tokens = stored(
        measured(docs, vocabulary, end_id, length).withColumn("row", F.monotonically_increasing_id()), "token-remainders", "zstd")
    rows = tokens.drop("rest_ids").withColumns({
        "rest": F.col("n") % length, "full": F.floor(F.col("n") / length).cast("long")
    }).withColumn("class", F.ceil(F.col("rest") / CLASS).cast("int")).withColumn("short", F.col("class") * CLASS - F.col("rest"))
    ranked = numbered(rows, ["class", "short", "doc_id", "row"], ["full"], "packing-ranks")

    units = length // CLASS
    lengths = np.zeros(units * CLASS + 1, np.int64)
    for r in ranked.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``length`` rows
        lengths[r["rest"]] = r["n"]
    demand = lengths[1:].reshape(units, CLASS).sum(axis=1)
    counts = {0: int(lengths[0])} | {k + 1: int(n) for k, n in enumerate(demand)}
    plan = planned(demand, units, lambda taken, items, uses: least_fill(lengths, taken, items, uses) / length)

    # the ranks of a class that each pattern takes: (class, from, to, uses, first sequence, slot)
    taken, segments, sequence = dict.fromkeys(range(units + 1), 0), [], 0
    for uses, items in plan.patterns:
        slot = 0
        for size, times in items:
            segments.append((size, taken[size], taken[size] + uses * times, uses, sequence, slot))
            taken[size] += uses * times
            slot += times
        sequence += uses
    before = [0, *np.cumsum([counts.get(k, 0) for k in range(units + 1)]).tolist()]
    of_class = lambda values: F.get(F.array(*(F.lit(int(v)).cast("long") for v in values)), F.col("class"))
    items = ranked.where(F.col("rest") > 0).withColumn("rank", F.col("position") - of_class(before[:-1]))
    in_plan = F.col("rank") < of_class([taken[k] for k in range(units + 1)])

    # 1. items of patterns keep together; their offsets follow from the items before them in the sequence
    plan_rows = spark.createDataFrame(
        segments, "class int, first long, last long, uses long, base long, slot long") if segments else None
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    start = F.col("full") * length
    if plan_rows is not None:
        # at most a row per class and pattern: bounded by the classes, not by the input
        located = items.where(in_plan).join(F.broadcast(plan_rows), "class").where("rank >= first and rank < last")
        at = F.col("rank") - F.col("first")
        slots = located.withColumns({
            "sequence_id": F.col("base") + at % F.col("uses"),
            "place": F.col("slot") + F.floor(at / F.col("uses")),
        })
        inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        whole = slots.select(
            "doc_id", start.alias("start"), F.col("rest").alias("length"), F.col("rest_crc").alias("ids_crc32"),
            F.col("n").alias("doc_tokens"), "sequence_id", F.coalesce(F.sum("rest").over(inside), F.lit(0)).alias("offset"),
        )
    else:
        whole = None

    # 2. the others lie end to end, numbered once more for their places
    line = numbered(items.where(~in_plan).drop("position", "full_before"), ["class", "rest", "doc_id", "row"], ["rest"], "packing-line")
    total = line.agg(F.sum("rest")).first()[0] or 0
    cuts = _tail_cuts(total, length)
    border = total // length * length
    a, b = F.col("rest_before"), F.col("rest_before") + F.col("rest")
    inner = F.filter(
        F.array_distinct(F.concat(F.array(F.floor(b / length).cast("long") * length), F.array(*(F.lit(c).cast("long") for c in [border, *cuts])))),
        lambda c: (c > a) & (c < b),
    )
    edges = F.sort_array(F.concat(F.array(a, b), inner))
    spans = F.transform(F.slice(edges, 1, F.size(edges) - 1), lambda e, i: F.struct(e.alias("from"), F.get(edges, i + 1).alias("to")))
    cut = line.withColumns({"cut": F.size(inner) > 0, "spans": spans}).select("*", F.explode("spans").alias("span"))
    passed = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in [border, *cuts])), lambda c: c <= F.col("span.from")))
    opened = F.get(F.array(*(F.lit(c).cast("long") for c in [0, border, *cuts])), passed)
    tail = F.col("span.from") >= border
    pieces = cut.select(
        "doc_id", "row", "cut", "rest_crc", (F.col("span.from") - a).alias("inside"), (start + F.col("span.from") - a).alias("start"),
        (F.col("span.to") - F.col("span.from")).alias("length"), F.col("n").alias("doc_tokens"),
        (F.lit(sequence) + F.when(tail, F.lit(border // length) + passed - 1).otherwise(F.floor(F.col("span.from") / length))).alias("sequence_id"),
        F.when(tail, F.col("span.from") - opened).otherwise(F.col("span.from") % length).alias("offset"),
    )
    uncut = pieces.where(~F.col("cut")).withColumnRenamed("rest_crc", "ids_crc32").select(*columns)
    own_ids = F.substring("rest_ids", (4 * F.col("inside") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    mended = pieces.where("cut").drop("rest_crc").join(tokens.select("row", "rest_ids"), "row").withColumn(
        "ids_crc32", F.crc32(own_ids)).select(*columns)
    sequence += border // length + len(cuts)

    # 3. full sequences of long documents
    full = ranked.where(F.col("full") > 0).select(
        "doc_id", "n", "full_before", F.posexplode("full_crcs").alias("at", "ids_crc32")
    ).select(
        "doc_id", (F.col("at") * F.lit(length).cast("long")).alias("start"), F.lit(length).cast("long").alias("length"), "ids_crc32",
        F.col("n").alias("doc_tokens"), (F.lit(sequence) + F.col("full_before") + F.col("at")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    parts = [p for p in (whole, uncut, mended, full) if p is not None]
    out = parts[0].select(*columns)
    for p in parts[1:]:
        out = out.unionByName(p.select(*columns))
    return out.select(*(F.col(c).cast("long").alias(c) for c in columns))
