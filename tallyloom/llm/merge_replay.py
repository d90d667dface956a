"""Byte-level BPE by replaying the merges over a corpus, and decoding.

The words that a task meets for the first time form a corpus: the bytes of all of them in one array, with
links to the neighbours. An inverted index leads from each mergeable pair (by its rank) to the places where
it stands. The ranks that occur are applied in ascending order, each to all its places at once; only the
pairs next to a merge are looked up again and entered under their rank. So each merge is one step of array
work for the whole corpus, however many words contain it.

Words are the matches of the split pattern, each encoded on its own; a worker process remembers the ids of the
pieces of text it has met (see ``tokens``). No text is shuffled.

Defined results: null text is empty: no ids, empty strings are hashed. Texts of any length are encoded whole.
Rows are independent, so repeated rows, ids and other columns don't matter; an empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import small_batches, text_or_empty
from tallyloom.llm.tokens import PieceEncoder, blocks, joined_spans, of_process

NO_RANK = np.int64(1) << 40


class Merges:
    """Ranks of a byte-level vocabulary; a token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], NO_RANK)

    def one_word(self, word: bytes) -> list[int]:
        """Plain encoding of a word: the lowest rank first, of equals the leftmost."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NO_RANK:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]


def _taken(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of ascending places of one rank, those that merge: left to right, no token in two merges."""
    touching = np.isin(places, following[places])
    if not touching.any():
        return places
    out, used = [], -1
    for p in places.tolist():
        if p != used:
            out.append(p)
            used = int(following[p])
    return np.array(out, np.int64)


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, number of ids of each word)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    whole = np.fromiter((merges.ranks.get(w, -1) for w in words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    token = merges.of_byte[raw]
    word = np.repeat(np.arange(len(words)), lengths)
    following, previous = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(lengths)
    full = lengths > 0
    following[ends[full] - 1] = -1
    previous[(ends - lengths)[full]] = -1
    alive = np.ones(n, bool)

    # inverted index: rank -> places of the left token of such a pair
    rank = np.full(n, NO_RANK)
    inner = np.flatnonzero((following >= 0) & (whole[word] < 0))  # words that are tokens need no merge
    rank[inner] = merges.rank(token[inner], token[following[inner]])
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(places: np.ndarray) -> None:
        places = places[rank[places] < NO_RANK]
        if not len(places):
            return
        by_rank = np.argsort(rank[places], kind="stable")
        places, ranks = places[by_rank], rank[places][by_rank]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
            if r not in index:
                index[r] = []
                heapq.heappush(waiting, r)
            index[r].append(part)

    enter(inner)
    odd: set[int] = set()
    while waiting:
        r = heapq.heappop(waiting)
        lists = index.pop(r)
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        places = places[rank[places] == r]  # others have changed since they were entered
        if not len(places):
            continue
        places = _taken(np.sort(places), following)
        gone = following[places]
        after = following[gone]
        token[places] = r
        following[places] = after
        previous[after[after >= 0]] = places[after >= 0]
        alive[gone] = False
        rank[gone] = NO_RANK
        # only the pairs beside a merge change
        before = previous[places]
        touched = np.unique(np.concatenate([places, before[before >= 0]]))
        right = following[touched]
        rank[touched] = NO_RANK
        inside = touched[right >= 0]
        rank[inside] = merges.rank(token[inside], token[following[inside]])
        early = inside[rank[inside] < r]
        if len(early):  # a pair that should have come first: such words are encoded one by one
            odd.update(word[early].tolist())
        enter(inside)

    ids, counts = token[alive], np.bincount(word[alive], minlength=len(words))
    single = whole >= 0
    if single.any() or odd:
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(single).tolist():
            parts[i] = whole[i:i + 1]
        for i in odd:
            if not single[i]:
                parts[i] = np.array(merges.one_word(words[i]), np.int64)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.concatenate(parts)
    return ids, counts


class Replay:
    """Encoder of texts by the ranks at ``path``, with the bytes and the decimal form of each id."""

    def __init__(self, path: str, pattern: str):
        import regex

        merges = Merges(path)
        # \s is the Unicode property, as in the library whose ids are to be met
        find = regex.compile(pattern).findall

        def encode_new(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
            numbers: dict[bytes, int] = {}
            spread, per_piece = [], []
            for piece in new:
                found = find(piece)
                per_piece.append(len(found))
                spread.extend(numbers.setdefault(w.encode(), len(numbers)) for w in found)
            if not numbers:
                return np.zeros(0, np.int64), np.zeros(len(new), np.int64)
            ids, counts = replay(list(numbers), merges)
            at = np.array(spread, np.int64)
            n = counts[at]
            flat = ids[joined_spans((np.cumsum(counts) - counts)[at], n)]
            bounds = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per_piece)])]
            return flat, np.diff(bounds)

        self.encode = PieceEncoder(encode_new, False).encode
        top = max(merges.tokens) + 1
        self.token_bytes = [merges.tokens.get(i, b"") for i in range(top)]
        self.decimal = [str(i).encode() for i in range(top)]


def encoded_and_decoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and SHA-256 of the decimal ids and of the bytes decoded from them."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_process(f"{ranks} {pattern}", lambda: Replay(ranks, pattern))
        token_bytes, decimal = encoder.token_bytes, encoder.decimal
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in blocks(texts):
                ids, counts = encoder.encode(texts[part])
                rows, end = [], 0
                for n in counts.tolist():
                    own = ids[end:end + n].tolist()
                    end += n
                    rows.append((
                        hashlib.sha256(b" ".join(map(decimal.__getitem__, own))).hexdigest(),
                        hashlib.sha256(b"".join(map(token_bytes.__getitem__, own))).hexdigest(),
                    ))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[part.start:part.stop], pa.array(counts, pa.int64()),
                    pa.array([a for a, _ in rows], pa.string()), pa.array([b for _, b in rows], pa.string()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
