"""Removal of long byte strings that stand anywhere else, by blockwise suffix sorting.

Suffixes are sorted one bucket at a time: all windows with the same anchor (``repeats``) and the
same distance to it form a bucket, so equal windows share a bucket and a residue modulo the
period of a difference cover.  Suffixes are told apart by their first bytes up to the next cover
position; long ties are settled by ranks of the cover samples, which are computed beforehand for
the block by doubling.  Memory is bounded by the block, whatever the length of the repeats.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import keyed
from .repeats import Windows, repeated_spans, run_lengths, without_spans


def difference_cover(period: int) -> np.ndarray:
    """Residues whose differences give every residue: a run of small ones, then steps of it."""
    width = int(np.ceil(np.sqrt(period)))
    cover = sorted({*range(width), *range(0, period, width)})
    assert len({(a - b) % period for a in cover for b in cover}) == period
    return np.array(cover)


def _dense(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by several keys (first key leads) and their dense ranks."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def _pieces(text: np.ndarray, at: np.ndarray, size: np.ndarray | int, most: int) -> list[np.ndarray]:
    """``size`` bytes from each position as big-endian integers of 8 bytes, zero behind the end."""
    out = []
    for lead in range(0, most, 8):
        value = np.zeros(len(at), dtype=np.uint64)
        for b in range(lead, lead + 8):
            value <<= np.uint64(8)
            if b < most:
                value |= np.where(b < size, text[at + b], 0).astype(np.uint64)
        out.append(value)
    return out


class CoverRanks:
    """Ranks of the strings of ``reach`` bytes at the cover positions of a text."""

    def __init__(self, text: np.ndarray, period: int, doublings: int):
        self.cover = difference_cover(period)
        self.period, self.reach = period, period << doublings
        inside = np.zeros(period, dtype=bool)
        inside[self.cover] = True
        # Bytes from each residue to the next cover position.
        self.ahead = np.array([next(d for d in range(period) if inside[(r + d) % period]) for r in range(period)])
        usable = len(text) - self.reach + 1
        at = np.flatnonzero(np.resize(inside, len(text)))
        at = at[at + period <= len(text)]
        self.rank = np.full(len(text), -1, dtype=np.int64)
        if not len(at) or usable <= 0:
            return
        _, rank = _dense(_pieces(text, at, period, period))
        self.rank[at] = rank
        width = period
        for _ in range(doublings):
            at = at[at + 2 * width <= len(text)]
            if not len(at):
                break
            _, rank = _dense([self.rank[at] * (len(text) + 1) + self.rank[at + width]])
            fresh = np.full(len(text), -1, dtype=np.int64)
            fresh[at] = rank
            self.rank = fresh
            width *= 2


def sorted_windows(text: np.ndarray, begin: np.ndarray, bucket: np.ndarray, length: int, ranks: CoverRanks
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows by bucket and content, and whether each equals the one before it.

    All windows of a bucket have the same residue.  A window is its bytes up to the next cover
    position, two ranked strings that overlap, and the bytes left over.
    """
    head = ranks.ahead[begin % ranks.period]
    x = begin + head
    second = (length - ranks.reach - ranks.period) // ranks.period * ranks.period
    y = x + second
    done = head + second + ranks.reach
    keys = [bucket, *_pieces(text, begin, head, int(ranks.ahead.max(initial=0))), ranks.rank[x], ranks.rank[y],
            *_pieces(text, begin + done, length - done, int((length - done).max(initial=0)))]
    order, rank = _dense(keys)
    same = np.zeros(len(order), dtype=bool)
    ranked = rank[order]
    same[1:] = ranked[1:] == ranked[:-1]
    return order, same


def suffix_index(length: int, period: int = 25):
    """Index for ``repeats``: windows that equal a neighbour in the sorted order, or whose segment
    stands more than once, are repeated."""
    # Two ranked strings have to cover a window but for its head and tail.
    doublings = max(0, int(np.ceil(np.log2((length - period) / (2 * period)))))

    def look(data, n, first, last, windows, at):
        # Each segment starts where its anchor falls on a multiple of the period, so that equal
        # windows of different segments have the same residue.
        starts, size = [], 0
        for d, a in zip(data, at.tolist()):
            size += -(size + a) % period
            starts.append(size)
            size += len(d) + period
        text = np.zeros(size + length + 8, dtype=np.uint8)
        for s, d in zip(starts, data):
            text[s:s + len(d)] = np.frombuffer(d, dtype=np.uint8)
        ranks = CoverRanks(text, period, doublings)
        begin = np.concatenate([np.arange(s, s + w) for s, w in zip(starts, windows.tolist())])
        owner = np.repeat(np.arange(len(data)), windows)
        # Distance to the anchor; anchors are told apart by the content that follows.
        distance = np.repeat(np.array(starts) + at, windows) - begin
        order, same = sorted_windows(text, begin, distance, length, ranks)
        group = np.cumsum(~same)
        count = np.bincount(group, weights=n[owner[order]].astype(float))
        hit = np.zeros(len(begin), dtype=bool)
        hit[order] = count[group] > 1
        return [run_lengths(np.zeros(w, dtype=np.int64), h)
                for w, h in zip(windows.tolist(), np.split(hit, np.cumsum(windows)[:-1]))]
    return look


def _apply(text: bytes, spans: list[tuple[int, int]]) -> dict:
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a])
        last = b
    kept = b"".join([*kept, text[last:]])
    return {"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(spans), "kept": kept}


def drop_repeated_bytes(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Remove every byte in a string of ``length`` (50 or more) bytes that also starts anywhere
    else, in the same document too; overlapping occurrences count.

    Returns ``key, n_bytes, n_removed, n_spans, kept`` (binary) per input row.
    Texts are UTF-8 bytes; null counts as empty.  A repeated row is another place, so it
    removes and is removed.  Rows without an id are treated like all others.
    """
    rows = keyed(docs, text, key)
    spec = Windows(length, max(1, length * 2 // 5), words=False, rule="anywhere")
    spans = repeated_spans(rows, spec, suffix_index(length))
    return without_spans(rows, spans, _apply, "n_bytes long, n_removed long, n_spans long, kept binary",
                         ["_id"]).withColumnRenamed("_id", key)
