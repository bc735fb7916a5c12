"""Windows, substring dedup and suffix dedup."""

import random
from collections import Counter

import numpy as np
import pytest

from brute import byte_repeats, passages
from twinledger.llm import repeats, windows
from twinledger.llm.common import keyed
from twinledger.llm.substring_dedup import SuffixAutomaton, drop_repeated_passages
from twinledger.llm.suffix_dedup import CoverRanks, difference_cover, drop_repeated_bytes, sorted_windows, suffix_index


def corpus(seed, alphabet, lengths, joint=" "):
    """Texts that share passages, repeat themselves, are copies, empty or null; ids repeat or are null."""
    rng = random.Random(seed)
    make = lambda n: joint.join(rng.choice(alphabet) for _ in range(n))
    shared = [make(n) for n in lengths]
    rows = []
    for d in range(40):
        parts = [make(rng.randint(0, lengths[0])) for _ in range(3)] + rng.choices(shared, k=2)
        rng.shuffle(parts)
        rows.append((d, joint.join(parts)))
    rows += [(40, None), (41, ""), (42, "   \n "), (43, rows[7][1]), (44, rows[7][1]), (None, rows[7][1]), (None, rows[8][1]),
             (9, rows[9][1]), (9, rows[3][1]), (45, joint.join(["q"] * lengths[1])), (46, joint.join(["q"] * (lengths[1] + 5)))]
    return rows


def test_segments_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(windows, "SLICE", 64)
    rng = np.random.default_rng(1)
    codes = [rng.integers(1, 5, n).astype(np.uint64) for n in (0, 3, 10, 300, 64, 65, 200)]
    seen = Counter()
    groups = {}
    for s in windows.segments(codes, 10, 4):
        for t, a, w, anchor in zip(s.text.tolist(), s.start.tolist(), s.windows.tolist(), s.anchor.tolist()):
            for i in range(a, a + w):
                seen[t, i] += 1
                groups.setdefault(tuple(codes[t][i:i + 10].tolist()), set()).add(anchor)
    assert seen == Counter((t, i) for t, c in enumerate(codes) for i in range(len(c) - 9))
    assert all(len(g) == 1 for g in groups.values())  # equal windows meet


def test_word_codes_in_pieces(monkeypatch):
    text = " a\tbb  ccc\x0bdddd ".encode() + "é ü".encode() + b" " + b"x" * 50
    whole = windows.word_codes(text).tolist()
    monkeypatch.setattr(windows, "SLICE", 8)
    assert windows.word_codes(text).tolist() == whole
    monkeypatch.setattr(windows, "PIECE", 8)
    assert windows.word_codes(text).tolist() == whole
    assert len(set(whole)) == 7 and windows.word_codes(b"bb").tolist() == whole[1:2]
    assert windows.word_codes(b"").tolist() == [] and windows.word_codes(b"  ").tolist() == []


def test_automaton_matches_brute_force():
    rng = random.Random(4)
    parts = [[rng.randrange(3) for _ in range(rng.randint(0, 25))] for _ in range(12)]
    a = SuffixAutomaton()
    for owner, p in enumerate(parts):
        a.add(p, owner)
    a.settle()
    for p in parts:
        for n in (1, 3, 6):
            want = [min(o for o, q in enumerate(parts) if any(q[j:j + n] == p[i:i + n] for j in range(len(q) - n + 1)))
                    for i in range(len(p) - n + 1)]
            assert a.first_owners(p, n) == want


@pytest.mark.parametrize("period", [1, 2, 7, 25, 32])
def test_difference_cover(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_blockwise_order_is_lexicographic():
    rng = np.random.default_rng(3)
    length, period = 60, 7
    text = np.concatenate([rng.integers(97, 99, 900), np.zeros(length + 8)]).astype(np.uint8)
    ranks = CoverRanks(text, period, 2)
    begin = np.arange(3, 800, period)  # one bucket: one residue
    order, same = sorted_windows(text, begin, np.zeros(len(begin)), length, ranks)
    cut = [bytes(text[b:b + length]) for b in begin[order]]
    assert cut == sorted(cut)
    assert same.tolist() == [False] + [x == y for x, y in zip(cut, cut[1:])]


def test_suffix_index_on_shifted_copies():
    rng = random.Random(8)
    core = bytes(rng.choice(b"ab") for _ in range(70))
    data = [b"x" + core, core + b"yy", bytes(rng.choice(b"ab") for _ in range(70))]
    found = suffix_index(60, 7)(data, *(np.array(x) for x in ([1, 1, 1], [1, 2, 3], [1, 2, 3], [12, 13, 11], [9, 8, 5])))
    assert [[(r["from"], r["to"]) for r in f] for f in found] == [[(1, 12)], [(0, 11)], []]


def rows_of(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, anchor string, _id int, spans int")


@pytest.mark.parametrize("crowd", [2000, 1])
def test_passages(spark, monkeypatch, crowd):
    rows = corpus(1, ["the", "of", "a", "b", "c", "d"], [12, 30, 9])
    plain = repeats.Windows.__init__
    monkeypatch.setattr(repeats.Windows, "__init__", lambda self, *a, **k: plain(self, *a, **{**k, "crowd": crowd}))
    got = drop_repeated_passages(rows_of(spark, rows), length=10)
    assert Counter(map(tuple, got.collect())) == Counter(passages(rows, 10))


@pytest.mark.parametrize("crowd", [2000, 1])
def test_bytes(spark, monkeypatch, crowd):
    rows = corpus(2, list("abé"), [40, 150, 70], "")
    plain = repeats.Windows.__init__
    monkeypatch.setattr(repeats.Windows, "__init__", lambda self, *a, **k: plain(self, *a, **{**k, "crowd": crowd}))
    got = drop_repeated_bytes(rows_of(spark, rows), length=60)
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.collect()) == Counter(byte_repeats(rows, 60))


def test_empty_table(spark):
    none = rows_of(spark, []).filter("false")
    assert drop_repeated_passages(none).collect() == [] and drop_repeated_bytes(none).collect() == []


def thue_morse(n, one, zero):
    """Two strings that differ everywhere; every polynomial modulo a power of two takes them for equal."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [one if b else zero for b in bits], [zero if b else one for b in bits]


def test_words_that_a_polynomial_mixes_up():
    a, b = ("".join(x) for x in thue_morse(1024, "a", "b"))
    assert len(set(windows.word_codes(f"{a} {b} {a}".encode()).tolist())) == 2


def test_strings_that_a_polynomial_mixes_up(spark):
    a, b = ("".join(x) for x in thue_morse(1024, "a", "b"))
    words = lambda x: [f"w{i} {x}" for i in range(3)]
    rows = [(1, " ".join(words(a) * 20)), (2, " ".join(words(b) * 20)), (3, " ".join(words(a) * 10)), (4, a), (5, b), (6, " ".join(words(b) * 9))]
    many = ["".join(x) for x in thue_morse(2048, "left ", "right ")]
    rows += [(10, many[0]), (11, many[1]), (12, "x " + many[0][:3000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, drop_repeated_passages(docs, 50).collect())) == Counter(passages(rows, 50))
    got = drop_repeated_bytes(docs, 400).collect()
    assert Counter((*r[:4], bytes(r[4]) if not isinstance(r[4], str) else r[4].encode()) for r in map(tuple, got)) == Counter(byte_repeats(rows, 400))


def test_few_crowded_segments_do_not_move_the_texts(spark):
    docs = keyed(spark.createDataFrame([(d, " ".join(f"w{d}x{i}" for i in range(20))) for d in range(6)], "doc_id long, text string"))
    crowded = docs.where("_id < 2").selectExpr("7l as anchor", "cast('c' as binary) as content", "1l as n", "_id as first", "_id as last", "_id", "_h", "0 as start", "3 as windows", "0 as at")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only what is found to be small is sent
    try:
        out = repeats._segment_rows(docs, crowded, repeats.Windows(5, 2, words=True, rule="earlier"), digests=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert out.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
