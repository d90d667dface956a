"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents are linked through hubs (equal texts share one), never pairwise; a hub with several documents is a
group. Groups of over half a shard are at most a few per shard: the driver places them, the largest first, each in the
fullest shard that holds it or, if none does, in as few shards as it needs. The other linked documents start on the
shards in the order of a hash, as evenly as these have room and without regard of their links.

Then come rounds of joins. Hubs count the labels of their documents; documents meet their hubs' strongest labels again
and wish for the shard that has most neighbours there, if it has more of them than their own. What a document gains is
the difference. Wishes are counted by pair of shards and class of gain (powers of two). Which of them are granted is the
linear programme of the method: most gain, no shard beyond its capacity, where what flows out of a shard makes room in
it. On a network of shards that is a flow of least loss, which the driver finds. Of each pair of shards the wishes of
highest gain move, in the last class those of the smallest hashes; the wishes of one hub of equal gain are granted or
refused together. Rounds end when no wish is left or can be granted. Labels travel from hub to hub where documents
belong to several. Groups that the rounds left cut and what lies beyond a capacity after that are numbered and laid into
the places that are left; groups across a border there (one per shard at most) the driver places like the large ones.
Documents without links fill up, so counts differ by one at most.

A round writes one table to the shared folder; the driver sees one number per pair of shards and class of gain, the large
groups and those at borders.

Defined results: null text has size 16, crc 0 and the empty text's hub; rows equal in id and text are
separate documents of one hub, null ids are ids like others; texts of any length count whole; hubs with equally strong
labels prefer one by a hash of hub and shard; columns besides doc_id and text are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import numbered, stored, text_or_empty

IDENTITY = ("hub", "doc_id", "copy")  # in this order, so that a full shard turns whole groups away


@dataclass(frozen=True)
class Settings:
    shards: int = 40
    rounds: int = 20


def nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, hub, copy) per row of ``docs``; hub: 128-bit hash of the text."""
    raw = text_or_empty().cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"), F.unhex(F.md5(raw)).alias("hub"),
    )
    # equal rows are counted before they are numbered, so that no task gathers them
    counted = rows.groupBy("doc_id", "size", "text_crc32", "hub").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select("doc_id", "size", "text_crc32", "hub", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))


def _choice(options: list, at: Column) -> Column:
    return F.get(F.array(*(F.lit(o) for o in options)), at)


def _passed(ends: list, at: Column) -> Column:
    """How many of the rising ``ends`` are not beyond ``at``: the number of the stretch that ``at`` lies in."""
    return F.size(F.filter(F.array(*(F.lit(e).cast("long") for e in ends)), lambda e: e <= at))


def granted(wishes: Mapping[tuple, int], load: list[int], room: list[int], gain: Mapping[tuple, int] | None = None) -> dict[tuple, int]:
    """Of the wished flows (from, to, ...), what gains most and leaves no shard above its room (or its load, if that is more).

    ``gain`` is that of one document of a flow, above 0 (1 without it). All wishes are granted at first, which gains most
    without regard of room; what a shard gets too much goes back along the paths of least loss, on which granted wishes
    are refused and refused ones granted. Refusing all is possible, so there always is a path.
    """
    n, far = len(room), 1 << 60
    steps: dict[tuple[int, int], list[list]] = {}  # by pair of shards, falling in gain: gain, wished, granted, wish
    for wish, count in sorted(wishes.items(), key=lambda w: (-gain[w[0]] if gain else -1, w[0])):
        steps.setdefault(wish[:2], []).append([gain[wish] if gain else 1, count, count, wish])
    loss, most = np.full((n, n), far, dtype=np.int64), [max(x) for x in zip(load, room)]
    ways: dict[tuple[int, int], tuple[list, int]] = {}  # from, to -> the step that carries a document there now, and how

    def look(a: int, b: int) -> None:
        """How a document gets from ``a`` to ``b`` at the least loss: back, or by a wish that was refused."""
        back = [(s[0], -1, s) for s in steps.get((b, a), ()) if s[2]]
        forth = [(-s[0], 1, s) for s in steps.get((a, b), ()) if s[2] < s[1]]
        found = min([*back[-1:], *forth[:1]], key=lambda f: f[0], default=None)
        loss[a, b] = found[0] if found else far
        if found:
            ways[a, b] = found[2], found[1]

    held = np.array(load, dtype=np.int64)
    for (a, b), own in steps.items():
        count = sum(s[1] for s in own)
        held[a] -= count
        held[b] += count
        look(a, b)
        look(b, a)
    for shard in range(n):
        while held[shard] > most[shard]:
            dist, came = np.full(n, far, dtype=np.int64), np.full(n, -1)
            dist[shard] = 0
            for _ in range(n):
                through = np.where(dist[:, None] < far, np.minimum(dist[:, None] + loss, far), far)
                best = through.argmin(axis=0)
                shorter = through[best, np.arange(n)] < dist
                if not shorter.any():
                    break
                dist, came = np.where(shorter, through[best, np.arange(n)], dist), np.where(shorter, best, came)
            end = min((t for t in range(n) if held[t] < most[t] and dist[t] < far), key=lambda t: dist[t])
            path, at = [], end
            while at != shard:
                path.append((int(came[at]), at))
                at = int(came[at])
            rooms = [s[2] if way < 0 else s[1] - s[2] for s, way in (ways[p] for p in path)]
            count = int(min(held[shard] - most[shard], most[end] - held[end], *rooms))
            for s, way in [ways[p] for p in path]:
                s[2] += way * count
            for a, b in path:
                look(a, b)
                look(b, a)
            held[shard] -= count
            held[end] += count
    return {s[3]: s[2] for own in steps.values() for s in own if s[2]}


@dataclass(frozen=True)
class Propagated:
    """``labels`` (node, shard), stored, and the cut edges before each round and at the end."""

    labels: DataFrame
    cut_edges: list[int]


def started(nodes: DataFrame, order: list[str], room: list[int]) -> DataFrame:
    """(node, shard) of ``nodes`` laid on the shards in the order of ``order``, in proportion to their room."""
    placed = numbered(nodes, order, label="shard-start")
    total, places = nodes.count(), max(sum(room), 1)
    ends = [sum(room[: s + 1]) * total // places for s in range(len(room) - 1)]
    return placed.select("node", (_passed(ends, F.col("position")) if ends else F.lit(0)).cast("int").alias("shard"))


def propagated(links: DataFrame, labels: DataFrame, room: list[int], rounds: int) -> Propagated:
    """Labels of the nodes of ``links`` (node, hub) after the rounds, from ``labels`` (node, shard).

    Loads may exceed the room slightly: of the last class of gain that its pair of shards grants, a hub's wishes are
    granted by its hash.
    """
    shards = len(room)
    links, cut_edges = stored(links.select("node", "hub"), "shard-links"), []
    state = stored(labels.select("node", "shard"), "shard-labels")
    for step in range(rounds + 1):
        labelled = links.join(state, "node")
        counts = labelled.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        hubs = stored(counts.groupBy("hub").agg(
            F.max_by(F.struct("shard", "n"), F.struct("n", F.xxhash64("hub", "shard"))).alias("best"), F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("n")).alias("squares"),
            F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("by_shard")), "shard-hubs")
        cut = hubs.agg(F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2)).first()[0]
        cut_edges.append(int(cut or 0))
        if step == rounds or not cut_edges[-1]:
            break
        # only documents of a hub that is cut can wish; all their hubs vote
        torn = hubs.where(F.col("best.n") < F.col("n")).select("hub")
        asked = links.join(torn, "hub", "left_semi").select("node").distinct()
        met = labelled.join(asked, "node", "left_semi").join(hubs.select("hub", "best", "by_shard"), "hub")
        votes = met.groupBy("node", "shard", F.col("best.shard").alias("target")).agg(
            F.sum("best.n").alias("weight"), F.min("hub").alias("hub"),
            F.sum(F.element_at("by_shard", F.col("shard")) - 1).alias("own"))  # neighbours in its own shard, without itself
        strongest = F.struct("weight", (F.col("target") == F.col("shard")).alias("stays"), -F.col("target"))
        best = votes.groupBy("node", "shard").agg(
            F.max_by(F.struct("target", "hub", "weight"), strongest).alias("w"), F.sum("own").alias("own"))
        gain = F.col("w.weight") - F.col("own")
        wishes = stored(best.where((F.col("w.target") != F.col("shard")) & (gain > 0)).select(
            "node", "shard", "w.target", "w.hub", gain.alias("gain"), F.length(F.bin(gain)).alias("class")), "shard-wishes")
        flow, mean = {}, {}
        for r in wishes.groupBy("shard", "target", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("gain").alias("gain")).collect():
            wish = r["shard"], r["target"], r["class"]
            flow[wish], mean[wish] = r["n"], r["gain"] // r["n"]
        load = [0] * shards
        for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per shard
            load[r["shard"]] = r["n"]
        given = granted(flow, load, room, mean)
        if not given:
            break
        # of each pair of shards the lowest class that is granted, and the share of it; classes above move whole
        lowest, share = [64] * shards**2, [0] * shards**2
        for (a, b, c), n in given.items():
            if c < lowest[a * shards + b]:
                lowest[a * shards + b], share[a * shards + b] = c, (1 << 31) * n // flow[a, b, c]
        pair = F.col("shard") * shards + F.col("target")
        drawn = F.pmod(F.xxhash64("hub", F.lit("move"), F.lit(step)), F.lit(1 << 31))
        moving = (F.col("class") > _choice(lowest, pair)) | ((F.col("class") == _choice(lowest, pair)) & (drawn < _choice(share, pair)))
        moves = wishes.where(moving).select("node", "target")
        state = stored(state.join(moves, "node", "left").select("node", F.coalesce("target", "shard").alias("shard")), "shard-labels")
    return Propagated(state, cut_edges)


class Places:
    """Free places of the shards, as stretches [a, b) of slots; one object per call, on the driver."""

    def __init__(self, used: Iterable[int], capacity: list[int]):
        self.free = [[(u, c)] if u < c else [] for u, c in zip(used, capacity)]

    def room(self, shard: int) -> int:
        return sum(b - a for a, b in self.free[shard])

    def take(self, shard: int, n: int) -> list[tuple[int, int, int]]:
        """The first ``n`` free places of a shard as (shard, slot, count)."""
        out = []
        while n:
            a, b = self.free[shard].pop(0)
            count = min(n, b - a)
            out.append((shard, a, count))
            n -= count
            if a + count < b:
                self.free[shard].insert(0, (a + count, b))
        return out

    def take_group(self, n: int) -> list[tuple[int, int, int]]:
        """Places in the fullest shard that has ``n``; without one, in the emptiest shards."""
        out = []
        while n:
            rooms = [(self.room(s), s) for s in range(len(self.free))]
            fitting = [x for x in rooms if x[0] >= n]
            room, shard = min(fitting) if fitting else max(rooms, key=lambda x: (x[0], -x[1]))
            out += self.take(shard, min(n, room))
            n -= min(n, room)
        return out

    def stretches(self) -> list[tuple[int, int, int]]:
        return [(s, a, b - a) for s, own in enumerate(self.free) for a, b in own]


def _laid(rows: DataFrame, pieces: list[tuple[int, int, int]]) -> DataFrame:
    """``rows``, numbered by ``position`` from 0, on the ``pieces`` (shard, slot, count) in this order."""
    if not pieces:
        return rows.withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")})
    starts = [sum(p[2] for p in pieces[:i]) for i in range(len(pieces))]
    at = _passed(starts[1:], F.col("position")) if len(pieces) > 1 else F.lit(0)
    return rows.withColumn("_at", at).withColumns({
        "shard": _choice([p[0] for p in pieces], F.col("_at")),
        "slot": F.col("position") + _choice([p[1] - start for p, start in zip(pieces, starts)], F.col("_at")),
    }).drop("_at")


def _around(across: list[tuple[int, int]], free: Places, total: int) -> list[tuple[int, int, int]]:
    """Pieces for ``total`` documents laid on the free places in order, but for the groups ``across`` a border (first
    position, n): these are placed as groups in what the others leave."""
    holes, found, at = free.stretches(), [], 0
    between = list(zip([0, *(first + n for first, n in sorted(across))], [*(first for first, _ in sorted(across)), total]))
    left = []
    for shard, slot, count in holes:
        a, end = slot, slot + count
        for low, high in between:
            low, high = max(low, at), min(high, at + count)
            if low < high:
                found.append((low, [(shard, slot + low - at, high - low)]))
                left.append((shard, a, slot + low - at))
                a = slot + high - at
        left.append((shard, a, end))
        at += count
    free.free = [[(a, b) for s, a, b in left if s == shard and a < b] for shard in range(len(free.free))]
    found += [(first, free.take_group(n)) for first, n in sorted(across, key=lambda g: (-g[1], g[0]))]
    return [piece for _, pieces in sorted(found) for piece in pieces]


def sharded(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot (gapless from 0 in its shard), grown_shard."""
    shards = settings.shards
    rows = stored(nodes(docs).withColumn("node", F.monotonically_increasing_id()), "shard-nodes")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    groups = stored(rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shard-groups")
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]

    # 1. large groups, in the order of their numbers: together they hold no more than all rows, so they are few
    is_large = 2 * F.col("n") > max(capacity)
    large = sorted((bytes(r["hub"]), r["n"]) for r in groups.where(is_large).collect())
    n_large = sum(n for _, n in large)
    free = Places([0] * shards, capacity)
    taken = {hub: free.take_group(n) for hub, n in sorted(large, key=lambda g: (-g[1], g[0]))}
    large_pieces = [piece for hub, _ in large for piece in taken[hub]]
    used = [c - free.room(s) for s, c in enumerate(capacity)]

    # 2. the others get a label; numbered by it, a shard's documents lie group by group, those of cut groups last
    room = [c - u for u, c in zip(used, capacity)]
    others = rows.join(groups.where(~is_large).select("hub"), "hub")
    drawn = others.withColumn("draw", F.xxhash64("doc_id", "hub", "copy"))
    labels = propagated(others, started(drawn, ["draw", *IDENTITY], room), room, settings.rounds).labels
    labelled = stored(others.join(labels, "node"), "shard-labelled")
    whole = labelled.groupBy("hub").agg(F.min("shard").alias("_least"), F.max("shard").alias("_most")).where("_least = _most").select("hub")
    of_large = rows.join(groups.where(is_large).select("hub"), "hub").withColumn("shard", F.lit(-1))
    both = labelled.join(whole, "hub", "left_semi").unionByName(of_large).unionByName(
        labelled.join(whole, "hub", "left_anti").withColumn("shard", F.lit(shards)))
    placed = numbered(both, ["shard", *IDENTITY], label="shard-places")
    load = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}  # one row per shard
    loads = [load.get(s, 0) for s in range(shards)]
    first = [n_large + sum(loads[:s]) for s in range(shards)]
    own = placed.where((F.col("shard") >= 0) & (F.col("shard") < shards)).withColumn("slot", F.col("position") + _choice([u - f for u, f in zip(used, first)], F.col("shard")))
    # a group that lies across its shard's capacity goes elsewhere as a whole
    spans = own.groupBy("shard", "hub").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    full = _choice(capacity, F.col("shard"))
    used = [min(u + n, c) for u, n, c in zip(used, loads, capacity)]
    for r in spans.where((F.col("first") < full) & (F.col("last") >= full)).collect():  # one group per shard at most
        used[r["shard"]] = r["first"]
    fits = F.col("slot") < _choice(used, F.col("shard"))

    # 3. what did not fit or was left cut lies group by group in the places left; groups across a border are placed for themselves
    left_cut = placed.where(F.col("shard") == shards).drop("shard", "position")
    turned = numbered(own.where(~fits).drop("shard", "slot", "position").unionByName(left_cut), list(IDENTITY), label="shard-turned")
    n_turned = n_large + sum(loads) + load.get(shards, 0) - sum(used)
    free = Places(used, capacity)
    ends = [sum(p[2] for p in free.stretches()[: i + 1]) for i in range(len(free.stretches()))]
    runs = turned.groupBy("hub").agg(F.min("position").alias("first"), F.max("position").alias("last"))
    across = [] if not ends else [
        (r["first"], r["last"] + 1 - r["first"]) for r in runs.where(_passed(ends, F.col("first")) < _passed(ends, F.col("last"))).collect()]
    turned_pieces = _around(across, free, n_turned)

    # 4. documents without links fill up
    alone = numbered(rows.join(groups.select("hub"), "hub", "left_anti"), list(IDENTITY), label="shard-queue")
    parts = [_laid(placed.where("shard < 0").drop("shard"), large_pieces), own.where(fits), _laid(turned, turned_pieces),
             _laid(alone, free.stretches())]
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
