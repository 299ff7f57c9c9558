"""Encoding with a public tokenizer, fast on corpora: each distinct chunk of text is encoded once.

The ids of a text are exactly those of ``Tokenizer.encode(text,
add_special_tokens=False)``.  The tokenizer drops white space and its merges
never cross a piece (a run of letters, a digit, a run of other signs), so the
ids of a text are the ids of its white-space-free chunks put together.  Chunks
are found and hashed (64 bits) with array operations over a block of texts,
looked up in a worker's hash table of known chunks, and only new ones go to
the library; chunks with characters whose case or form the library may treat
in its own way, or with special-token marks, go to it as they are.  Tables are
bounded and live as long as the worker: they save time and change no result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Known chunks and pieces that a worker keeps before it starts anew.
CHUNKS, PIECES = 1 << 21, 400_000
#: Bytes of text that are encoded together.
BLOCK = 1 << 21
END = 1

_LETTER, _DIGIT = r"[^\W\d_²³¹¼-¾]", r"[\d²³¹¼-¾]"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{_LETTER}+|{_DIGIT}|(?:[^\s\w]|_)+")
#: Printable ASCII and composed Latin letters and signs, less U+0130 and U+0131, whose case is special.
_PLAIN = re.compile("[!-~\\u00a1-\\u012f\\u0132-\\u024f]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _power(which: str, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        size = max(n, 2 * len(_powers[which]), BLOCK + 1)
        base = _BASE if which == "up" else _INVERSE
        _powers[which] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
    return _powers[which][:n]


def _chunks(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each run of anything but ASCII white space."""
    byte = np.frombuffer(raw, np.uint8)
    space = np.ones(len(raw) + 2, bool)
    np.take(_SPACE, byte, out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(byte * _power("up", len(raw)), out=sums[1:])
    h = (sums[end] - sums[start]) * _power("down", len(raw))[start] + (end - start).astype(np.uint64) * _INVERSE
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return start, end, h | (h == 0)     # 0 marks a free slot


class _Table:
    """Open addressing from chunk hash to number, probed for many hashes at once."""

    def __init__(self):
        self.size = 2 * CHUNKS
        self.key = np.zeros(self.size, np.uint64)
        self.number = np.zeros(self.size, np.int32)
        self.used = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The numbers, -1 where unknown."""
        out = np.full(len(h), -1, np.int32)
        slot = (h & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            at = slot[left]
            key = self.key[at]
            hit = key == h[left]
            out[left[hit]] = self.number[at[hit]]
            left = left[~hit & (key != 0)]
            slot[left] = (slot[left] + 1) & (self.size - 1)
        return out

    def add(self, h: np.ndarray, first: int) -> None:
        """Give distinct unknown hashes the numbers from ``first`` on."""
        slot = (h & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            at = slot[left]
            free = self.key[at] == 0
            _, lead = np.unique(at[free], return_index=True)
            take = left[free][lead]
            self.key[slot[take]] = h[take]
            self.number[slot[take]] = first + take
            left = left[self.key[at] != h[left]]
            slot[left] = (slot[left] + 1) & (self.size - 1)
        self.used += len(h)


class Encoder:
    """A word-BPE tokenizer file and what it has encoded so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer, pre_tokenizers
        self.full = Tokenizer.from_file(path)
        # pieces come lower-cased and cut: only the byte alphabet and the merges are left to do
        self.piece = Tokenizer(self.full.model)
        self.piece.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._empty()

    def _empty(self) -> None:
        self.table, self.pieces = _Table(), {}
        self.ids, self.filled = np.empty(1 << 16, np.uint32), 0        # ids of all known chunks, one after the other
        self.at, self.n = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32)

    def _learn(self, chunks: list[str]) -> list[list[int]]:
        if len(self.pieces) > PIECES:
            self.pieces = {}
        pieces, cut = self.pieces, [_PIECES.findall(c.lower()) if _PLAIN.fullmatch(c) and "<|" not in c else None for c in chunks]
        fresh = list({p for q in cut if q for p in q if p not in pieces})
        for p, e in zip(fresh, self.piece.encode_batch_fast(fresh, add_special_tokens=False)):
            pieces[p] = e.ids
        return [self.full.encode(c, add_special_tokens=False).ids if q is None else pieces[q[0]] if len(q) == 1 else [i for p in q for i in pieces[p]]
                for c, q in zip(chunks, cut)]

    def _add(self, raw: bytes, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> None:
        got = self._learn([raw[s:e].decode() for s, e in zip(start.tolist(), end.tolist())])
        n = np.fromiter(map(len, got), np.int32, len(got))
        flat = np.fromiter((i for x in got for i in x), np.uint32, int(n.sum()))
        first = self.table.used
        while self.filled + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.empty_like(self.ids)]
        while first + len(n) > len(self.n):
            self.at, self.n = np.r_[self.at, np.empty_like(self.at)], np.r_[self.n, np.empty_like(self.n)]
        self.ids[self.filled:self.filled + len(flat)] = flat
        self.n[first:first + len(n)] = n
        self.at[first:first + len(n)] = self.filled + np.cumsum(n) - n
        self.filled += len(flat)
        self.table.add(h, first)

    def block(self, texts: list[bytes], with_ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """Ids of all texts, one after the other (None if not asked for), and how many each has."""
        raw = b" ".join(texts)
        start, end, h = _chunks(raw)
        if self.table.used + len(h) > CHUNKS:
            self._empty()
            if len(h) > CHUNKS:         # one text with more chunks than a table holds
                return self._long(raw, with_ids, len(texts))
        number = self.table.find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, lead = np.unique(h[new], return_index=True)
            first = new[np.sort(lead)]
            self._add(raw, start[first], end[first], h[first])
            number[new] = self.table.find(h[new])
        n = self.n[number].astype(np.int64)
        ends = np.cumsum(n)
        begin = np.zeros(len(texts) + 1, np.int64)
        begin[1:] = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        upto = np.r_[0, ends][np.searchsorted(start, begin)]
        ids = None
        if with_ids:
            total = int(ends[-1]) if len(ends) else 0
            ids = self.ids[np.repeat(self.at[number] - (ends - n), n) + np.arange(total)]
        return ids, np.diff(upto)

    def _long(self, raw: bytes, with_ids: bool, texts: int) -> tuple[np.ndarray | None, np.ndarray]:
        """A block of one text, cut at white space into blocks of its own."""
        assert texts == 1, "blocks hold one text or less than a table's chunks"
        parts, at = [], 0
        while at < len(raw):
            to = at + BLOCK
            while to < len(raw) and raw[to] not in b"\t\n\x0b\x0c\r ":
                to += 1
            parts.append(self.block([raw[at:to]], with_ids))
            at = to
        return np.concatenate([p[0] for p in parts]) if with_ids else None, np.array([sum(int(p[1][0]) for p in parts)])

    def encode(self, text: str) -> np.ndarray:
        return self.block([text.encode()])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts (null: empty) of stretches of an Arrow string column, about BLOCK bytes each."""
    held, size, first = [], 0, 0
    for i, x in enumerate(column.cast(pa.binary())):
        x = x.as_py() or b""
        if held and size + len(x) > BLOCK:
            yield first, held
            held, size, first = [], 0, i
        held.append(x)
        size += len(x) + 1
    if held:
        yield first, held
