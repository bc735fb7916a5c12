"""Removal of long word passages that an earlier document holds, by suffix automata.

The repeated parts of the collection are the reference.  They are cut into shards by anchor
(``repeats``); each shard becomes one suffix automaton, shared by all segments of that shard,
which stream past it for matching statistics.  A state knows the smallest document its strings
stand in, so a window (``length`` words) goes when that document comes before its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import keyed
from .repeats import Windows, repeated_spans, run_lengths, without_spans
from .windows import word_bounds, word_codes


class SuffixAutomaton:
    """Automaton of all substrings of several sequences, with the smallest owner of each state."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.owner = [-1], [0], [1 << 63]

    def _state(self, size: int, link: int, owner: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        self.owner.append(owner)
        return len(self.size) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A state for the strings of ``q`` no longer than those that reach it from ``p``."""
        size, link, moves = self.size, self.link, self.next
        clone = self._state(size[p] + 1, link[q], self.owner[q], moves[q].copy())
        while p >= 0 and moves[p].get(symbol) == q:
            moves[p][symbol] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, sequence: list[int], owner: int) -> None:
        size, link, moves = self.size, self.link, self.next
        last = 0
        for symbol in sequence:
            q = moves[last].get(symbol)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._split(last, symbol, q)
                if owner < self.owner[last]:
                    self.owner[last] = owner
                continue
            p, last = last, self._state(size[last] + 1, 0, owner, {})
            while p >= 0 and symbol not in moves[p]:
                moves[p][symbol] = last
                p = link[p]
            if p >= 0:
                q = moves[p][symbol]
                link[last] = q if size[q] == size[p] + 1 else self._split(p, symbol, q)

    def settle(self) -> None:
        """Hand owners down the suffix links, longest strings first."""
        for s in np.argsort(-np.array(self.size), kind="stable").tolist():
            up = self.link[s]
            if up >= 0 and self.owner[s] < self.owner[up]:
                self.owner[up] = self.owner[s]

    def first_owners(self, sequence: list[int], length: int) -> list[int]:
        """For each window of the sequence the smallest owner that holds it (none: 2 ** 63)."""
        size, link, moves, owner = self.size, self.link, self.next, self.owner
        state, matched, out = 0, 0, []
        for i, symbol in enumerate(sequence):
            while state and symbol not in moves[state]:
                state = link[state]
                matched = size[state]
            if symbol in moves[state]:
                state = moves[state][symbol]
                matched += 1
            while size[link[state]] >= length if state else False:
                state = link[state]
                matched = size[state]
            if i >= length - 1:
                out.append(owner[state] if matched >= length else 1 << 63)
        return out


def automaton_index(length: int):
    """Index for ``repeats``: one automaton per shard, all its segments streamed past it."""
    def look(data, n, first, last, windows, at):
        codes = [word_codes(d) for d in data]
        _, dense = np.unique(np.concatenate(codes), return_inverse=True)
        ends = np.cumsum([len(c) for c in codes])
        parts = [p.tolist() for p in np.split(dense, ends[:-1])]
        automaton = SuffixAutomaton()
        for part, owner in zip(parts, first.tolist()):
            automaton.add(part, owner)
        automaton.settle()
        out = []
        for part in parts:
            owners = np.array(automaton.first_owners(part, length), dtype=np.uint64)
            out.append(run_lengths(owners.astype(np.int64), owners < np.uint64(1 << 63)))
        return out
    return look


def _apply(text: bytes, spans: list[tuple[int, int]]) -> dict:
    begin, end = word_bounds(text)
    keep = np.ones(len(begin), dtype=bool)
    for a, b in spans:
        keep[a:b] = False
    kept = b" ".join([text[a:b] for a, b in zip(begin[keep].tolist(), end[keep].tolist())])
    return {"n_words": len(begin), "n_removed": int((~keep).sum()), "kept": kept.decode("utf-8")}


def drop_repeated_passages(docs: DataFrame, length: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Remove every word in a run of ``length`` words that starts in a document of a smaller id.

    Returns ``key, n_words, n_removed, kept``, one row per input row.  Null texts
    count as empty: no words.  Documents without an id come after all others and remove nothing
    from each other; rows of the same id never remove from one another.  Words of the input are
    compared as they are; windows are judged on the input.  Other columns are ignored.
    """
    gram = max(1, length * 2 // 5)
    rows = keyed(docs, text, key)
    spec = Windows(length, gram, words=True, rule="earlier")
    spans = repeated_spans(rows, spec, automaton_index(length))
    return without_spans(rows, spans, _apply, "n_words long, n_removed long, kept string", ["_id"]
                         ).withColumnRenamed("_id", key)
