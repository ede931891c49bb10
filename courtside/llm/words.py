"""Words of many texts at once: positions and 64-bit hashes over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from courtside.llm.common import mix64

CHUNK_BYTES = 1_000_000  # texts handled at once; a longer text is a chunk of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) >= n:
        return _powers["up"], _powers["down"]
    made = {}
    for name, base in (("up", _BASE), ("down", _INVERSE)):
        p = np.full(1 << (n - 1).bit_length(), base, dtype=np.uint64)
        p[0] = 1
        made[name] = np.cumprod(p, dtype=np.uint64)
    if n <= 2 * CHUNK_BYTES:  # those of a very long text aren't kept
        _powers.update(made)
    return made["up"], made["down"]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) of about CHUNK_BYTES each."""
    first, size, part = 0, 0, []
    for i, t in enumerate(texts):
        if part and size + len(t) > CHUNK_BYTES:
            yield first, part
            first, size, part = i, 0, []
        part.append(t)
        size += len(t) + 1
    if part:
        yield first, part


class Words:
    """Words (runs without ASCII white space) of the given texts, in order.

    buf: all bytes, each text followed by a line feed; start, end: byte positions; doc: index of
    the word's text; rank: position within its text; count: words per text; hash (on demand).
    """

    def __init__(self, texts: list[bytes]):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[self.buf]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        edge = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(edge, self.start, side="right")
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.rank = np.arange(len(self.start)) - self.first[self.doc]

    def hashes(self) -> np.ndarray:
        return self.hashes_of(self.start, self.end)

    def hashes_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``start`` up to ``end``, wherever they stand."""
        up, down = _power(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.buf] * up[:len(self.buf)], dtype=np.uint64, out=total[1:])
        return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(text index, hash) of every run of ``n`` words; a text of fewer words gives one run of
        all its words, a text without words none."""
        h = self.hashes()
        if not len(h):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        acc = np.zeros(len(h), dtype=np.uint64)
        inside = np.minimum(n, self.count[self.doc] - self.rank)  # words from here to the text's end
        for i in range(n):
            shifted = np.zeros_like(h)
            shifted[:max(0, len(h) - i)] = h[i:]
            acc = mix64(acc * _BASE + np.where(inside > i, shifted, np.uint64(0)))
        keep = (self.rank == 0) | (inside == n)
        return self.doc[keep], acc[keep]
