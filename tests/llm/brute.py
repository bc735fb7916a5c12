"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def cover(n, starts, length):
    hit = [False] * n
    for s in starts:
        for i in range(s, s + length):
            hit[i] = True
    return hit


def passages(rows, length):
    """(id, text) to {row number: kept text, removed}: windows that start in a row of a smaller id."""
    big = float("inf")
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(first.get(k, big), big if d is None else d)
    out = []
    for (d, _), w in zip(rows, words):
        mine = big if d is None else d
        hit = cover(len(w), [i for i in range(len(w) - length + 1) if first[tuple(w[i:i + length])] < mine], length)
        out.append((d, len(w), sum(hit), " ".join(x for x, h in zip(w, hit) if not h)))
    return out


def byte_repeats(rows, length):
    seen = Counter(t[i:i + length] for _, x in rows for t in [(x or "").encode()] for i in range(len(t) - length + 1))
    out = []
    for d, x in rows:
        t = (x or "").encode()
        hit = cover(len(t), [i for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1], length)
        spans = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out.append((d, len(t), sum(hit), spans, bytes(b for b, h in zip(t, hit) if not h)))
    return out


def shingles(text, size):
    w = WORD.findall(lowered(text))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near_components(rows, size, percent):
    """Row number to the set of row numbers it hangs together with."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sets, {i: g for g in groups.values() for i in g}


def removed_lines(rows, percent):
    """rows of (order key, text): numbers of the lines that match an earlier one."""
    lines = []
    for at, (k, t) in enumerate(rows):
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(WORD.findall(lowered(line)))
            if s:
                lines.append(((k, i), s, at))
    gone = defaultdict(set)
    for p, s, at in lines:
        if any(q < p and 100 * len(s & u) >= percent * len(s | u) for q, u, _ in lines):
            gone[at].add(p[1])
    return gone
