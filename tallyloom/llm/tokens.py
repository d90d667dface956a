"""Token ids of whole texts by encoders that ask the library for every distinct piece once.

A chunk begins at a space that stands between two characters that are no white space. No token of the
byte-level or the word-end tokenizers reaches over such a point, so the ids of a text are the ids of its
chunks. A plain chunk (Latin-1 letters, ASCII digits and punctuation, single line feeds inside, no apostrophe)
falls into pieces of one class each; both tokenizers begin a new token where the class changes. Any other chunk
is one piece.

Pieces are cut for a block of texts at once and numbered by Arrow's dictionary encoding, so Python sees the
distinct pieces of a block only. A worker process remembers the ids of short pieces over all its tasks, in two
generations: what the older one holds and nobody asks for is forgotten.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa

_KEPT = "tallyloom_worker_encoders"
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
_ONE = re.compile(rf" ?(?:[{_LETTERS}]+|[0-9]+|[{_MARKS}]+)")
BLOCK_CHARS = 1 << 22
OTHER, LETTER, DIGIT, MARK, SPACE, LINE, WHITE = range(7)

Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def _classes() -> np.ndarray:
    """Class of every code point; white space (of which the highest is U+3000) comes last."""
    kind = np.zeros(0x110000, np.uint8)
    for code in range(0x3001):
        char = chr(code)
        if char in " \n":
            kind[code] = SPACE if char == " " else LINE
        elif char.isspace():
            kind[code] = WHITE
        elif _ONE.fullmatch(char):
            kind[code] = DIGIT if char.isdigit() else MARK if code < 128 and not char.isalpha() else LETTER
    return kind


def joined_spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the spans (start, length), one after the other."""
    total = np.cumsum(lengths)
    return np.repeat(starts - (total - lengths), lengths) + np.arange(total[-1] if len(total) else 0)


class PieceEncoder:
    """Ids of texts, put together from the ids of their pieces.

    ``encode_new`` gives, for a list of pieces, all their ids in one array and the number of ids of each. ``fold``
    holds for vocabularies of lower-case words without white space: pieces that differ in that only are one.
    """

    def __init__(self, encode_new: Encode, fold: bool, max_pieces: int = 600_000, max_bytes: int = 64):
        self.encode_new, self.fold, self.max_pieces, self.max_bytes = encode_new, fold, max_pieces, max_bytes
        self.kind = _classes()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def pieces(self, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        """(all pieces in their order, number of pieces up to the end of each text)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        filled = sizes > 0
        starts, lasts = (ends - sizes)[filled], ends[filled] - 1
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kind[codes]
        white = kind >= SPACE
        beside = np.zeros(len(codes), bool)  # next to white space or to the text's edge
        beside[1:] = white[:-1]
        beside[:-1] |= white[1:]
        beside[starts] = beside[lasts] = True
        begin = (kind == SPACE) & ~beside
        begin[starts] = True
        unsure = (kind == OTHER) | (kind == WHITE) | (white & beside)
        chunk = np.flatnonzero(begin)
        whole = np.zeros(len(codes), bool)
        if len(chunk) and unsure.any():
            whole = np.repeat(np.logical_or.reduceat(unsure, chunk), np.diff(np.append(chunk, len(codes))))
        edge = np.zeros(len(codes), bool)
        edge[1:] = kind[1:] != kind[:-1]
        if not self.fold:
            edge[1:] &= kind[:-1] != SPACE  # a space belongs to what follows
        edge = (edge & ~whole) | begin
        if self.fold:
            upper = ((codes - 65 < 26) | ((codes - 0xC0 < 31) & (codes != 0xD7))) & ~whole
            kept = whole | ~white
            codes, edge = (codes + 32 * upper.astype(np.uint32))[kept], edge[kept]
            ends = np.concatenate([[0], np.cumsum(kept)])[ends]
            data = codes.tobytes().decode("utf-32-le").encode()
        else:
            data = joined.encode()
        at = np.flatnonzero(edge)
        upto = np.searchsorted(at, ends)
        if len(data) > len(codes):  # places of bytes
            width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            at = (np.cumsum(width, dtype=np.int64) - width)[at]
        offsets = np.append(at, len(data)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), upto

    def _ids_of(self, names: list[bytes]) -> list[bytes]:
        """Ids (four bytes each) of distinct pieces."""
        if len(self.young) > self.max_pieces:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, names))
        new = []
        for i, value in enumerate(found):
            if value is None:
                value = self.old.get(names[i])
                if value is None:
                    new.append(i)
                else:
                    found[i] = self.young[names[i]] = value
        if new:
            ids, counts = self.encode_new([names[i].decode() for i in new])
            raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for i, start, end in zip(new, [0, *ends], ends):
                found[i] = raw[start:end]
                if len(names[i]) <= self.max_bytes:
                    self.young[names[i]] = found[i]
        return found

    def _block(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, upto = self.pieces(texts)
        coded = pieces.dictionary_encode()
        values = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        index = coded.indices.to_numpy()
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        of_each = lengths[index]
        flat = np.frombuffer(b"".join(values), "<u4")[joined_spans((np.cumsum(lengths) - lengths)[index], of_each)]
        return flat, np.diff(np.concatenate([[0], np.cumsum(of_each)])[upto], prepend=0)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text); a long text is cut at spaces for the work."""
        parts: list[str] = []
        owner: list[int] = []
        for number, text in enumerate(texts):
            start = 0
            while len(text) - start > BLOCK_CHARS and (cut := _SAFE_SPACE.search(text, start + BLOCK_CHARS - 1024)):
                parts.append(text[start:cut.start()])
                owner.append(number)
                start = cut.start()
            parts.append(text[start:] if start else text)
            owner.append(number)
        done = [self._block(parts[some]) for some in blocks(parts)]
        if not done:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        counts = np.bincount(owner, np.concatenate([c for _, c in done]), len(texts)).astype(np.int64)
        return np.concatenate([ids for ids, _ in done]), counts


def of_process(name: str, build: Callable[[], object]) -> object:
    """What ``build`` gives, built once per worker process.

    Task code comes by value, so names of this module are new in each task; a module of the process keeps
    the object, and a worker that Spark uses again has the vocabulary and the pieces of its earlier tasks.
    """
    kept = vars(sys.modules.setdefault(_KEPT, ModuleType(_KEPT)))
    if name not in kept:
        kept[name] = build()
    return kept[name]


def library_encoder(path: str) -> PieceEncoder:
    """The process's encoder by the tokenizers library with the vocabulary file at ``path``."""
    return of_process(path, lambda: _new_encoder(path))


def _new_encoder(path: str) -> PieceEncoder:
    """Special tokens are ordinary text. Whether case and white space count is asked of the vocabulary itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    def encode_new(new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.zeros(len(new), np.int64)
        plain = np.array([bool(_ONE.fullmatch(piece)) for piece in new], bool) & (divider is not None)
        spans = np.zeros(len(new), np.int64)
        parts, used = [], 0
        for mask, together in ((plain, 64), (~plain, 1)):
            places = np.flatnonzero(mask)
            for at in range(0, len(places), 4096):
                some = [new[i] for i in places[at:at + 4096]]
                lines = some if together == 1 else [
                    divider[0].join(["", *some[k:k + together], ""]) for k in range(0, len(some), together)]
                found = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
                if together == 1:
                    of_each = [e.ids for e in found]
                    sizes = np.array(list(map(len, of_each)), np.int64)
                    ids = np.fromiter((i for each in of_each for i in each), np.uint32)
                else:
                    ids, sizes = [], []
                    for e in found:
                        line = np.array(e.ids, np.uint32)
                        cuts = np.flatnonzero(line == divider[1])
                        sizes.append(np.diff(cuts) - 1)
                        ids.append(line[line != divider[1]])
                    ids, sizes = np.concatenate(ids), np.concatenate(sizes)
                counts[places[at:at + 4096]] = sizes
                spans[places[at:at + 4096]] = used + np.cumsum(sizes) - sizes
                parts.append(ids)
                used += len(ids)
        return np.concatenate(parts)[joined_spans(spans, counts)], counts

    divider = None
    for text in ("\n", " — "):  # no plain piece holds either; taken if it is one id that stands for itself
        ids = [encode_new([x])[0].tolist() for x in (text, "a", f"a{text}a")]
        if len(ids[0]) == 1 and ids[2] == ids[1] + ids[0] + ids[1]:
            divider = text, ids[0][0]
            break
    probe = " A B,C\nD"
    alike = encode_new([probe])[0].tolist() == encode_new(["a b,c d"])[0].tolist()
    return PieceEncoder(encode_new, alike)


def blocks(texts: Sequence[str], max_chars: int = BLOCK_CHARS) -> Iterator[slice]:
    """Consecutive texts of at most ``max_chars`` characters together, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > max_chars:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))
