"""Content-defined grouping of fixed-length windows, vectorised with numpy.

A window is ``length`` consecutive units (bytes, words, tokens) of one text.  Its *anchor* is the
``gram``-unit string with the smallest hash inside the window (the leftmost on ties), so the
anchor depends on the window's content alone: equal windows have equal anchors, wherever they
stand.  Consecutive windows with the same anchor position form a *segment*.  Grouping segments
by anchor brings all copies of every window together while each window travels once.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
# Units hashed at once: bounds the memory of a task, also for one endless text.
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wraps around)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * BASE) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse for i below ``n``, kept for the life of the worker."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


class Hashes:
    """Hashes of all substrings of one length, by prefix sums of a polynomial.  Strings that differ may
    share one (modulo 2 ** 64 some do under any base): good for choosing and gathering, not for comparing."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes) + 1)
        self.prefix = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * up[:-1], out=self.prefix[1:])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.prefix) - k
        return mix((self.prefix[k:] - self.prefix[:-k]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values (block-wise prefix and suffix minima)."""
    n = len(values)
    if n < width:
        return values[:0]
    pad = -n % width
    grid = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


@dataclass
class Segments:
    """Segments of a batch of texts: the text's index, the first window, the number of windows,
    where the anchor stands, the hash of the anchor and, if asked for, a digest of the units covered."""
    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    at: np.ndarray
    anchor: np.ndarray
    content: list[bytes] | None


def _segments(units: np.ndarray, text_of: np.ndarray, first: np.ndarray, length: int, gram: int, content: bool) -> Segments | None:
    n = len(units) - length + 1
    if n <= 0:
        return None
    # Anchors may share a hash: that brings windows together that differ, and their contents tell them apart.
    hashes = Hashes(BYTE_CODES[units] if units.dtype == np.uint8 else units)
    grams = hashes.grams(gram)
    low = np.uint64(0xFFFFFFFF)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(packed, length - gram + 1) & low).astype(np.int64)[:n]
    inside = text_of[:n] == text_of[length - 1:]
    new = np.ones(n, dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    if not len(starts):
        return None
    stops = np.flatnonzero(np.append(new[1:] | ~inside[1:], True) & inside) + 1
    p = at[starts]
    digests = None
    if content:
        raw, size = memoryview(np.ascontiguousarray(units)).cast("B"), units.itemsize
        digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest()
                   for a, b in zip((starts * size).tolist(), ((stops + length - 1) * size).tolist())]
    return Segments(text_of[starts], starts - first[text_of[starts]], stops - starts, p - first[text_of[starts]],
                    grams[p].view(np.int64), digests)


def segments(units: list[np.ndarray], length: int, gram: int, content: bool = True):
    """Segments of several texts given as units (bytes or word codes), in bounded pieces.  A text longer than a
    piece is cut with an overlap, so that each of its windows is seen exactly once."""
    group: list[tuple[int, int, np.ndarray]] = []
    held = 0

    def flush():
        joined = np.concatenate([g[2] for g in group])
        sizes = np.array([len(g[2]) for g in group])
        ends = np.cumsum(sizes)
        found = _segments(joined, np.repeat(np.arange(len(group)), sizes), ends - sizes, length, gram, content)
        if found is not None:
            skip = np.array([g[1] for g in group])[found.text]
            found.start, found.at = found.start + skip, found.at + skip
            found.text = np.array([g[0] for g in group])[found.text]
            return found
        return None

    for i, c in enumerate(units):
        if len(c) < length:
            continue
        for cut in range(0, len(c) - length + 1, SLICE):
            piece = c[cut:cut + SLICE + length - 1]
            group.append((i, cut, piece))
            held += len(piece)
            if held >= SLICE:
                out = flush()
                if out is not None:
                    yield out
                group, held = [], 0
    if group:
        out = flush()
        if out is not None:
            yield out


def byte_units(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the words of a text begin and end; words are the runs of bytes that are no white space."""
    gap = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
    return edge[::2], edge[1::2]


# Bytes of a text that are split at once.
PIECE = 4 << 20
_GAP = re.compile(rb"[ \t-\r]")
_checked = False


def _same_everywhere() -> None:
    """Codes are Python's keyed hashes of bytes (SipHash), alike in all workers because Spark gives them one seed."""
    global _checked
    if not _checked and TaskContext.get() is not None and "PYTHONHASHSEED" not in os.environ:
        raise RuntimeError("workers need one PYTHONHASHSEED, as Spark sets it")
    _checked = True


def word_codes(data: bytes) -> np.ndarray:
    """A 64-bit code per word of a text, the same in all workers of a session."""
    _same_everywhere()
    out, low = [], 0
    while low < len(data):
        gap = _GAP.search(data, low + PIECE) if low + PIECE < len(data) else None
        high = gap.start() if gap else len(data)
        words = (data[low:high] if (low, high) != (0, len(data)) else data).split()
        out.append(np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64) | np.uint64(1))
        low = high
    return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, dtype=np.uint64), *out])
