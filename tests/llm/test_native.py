"""Secret scan, exact dedup, mixing, decontamination."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import WORD, lowered
from twinledger.llm import decontaminate, mixing
from twinledger.llm.decontaminate import contaminated, drop_contaminated
from twinledger.llm.exact_dedup import ContentTable, exact_groups
from twinledger.llm.mixing import mix_sources, source_targets, split_quotas
from twinledger.llm.secret_scan import RULES, Rule, scan_secrets, trigram_query

PYTHON = frozenset({"SQL", "Pandas", "Python", "Arrow"})


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))


def test_trigram_queries():
    assert trigram_query("AKIA[A-Z]+") == [frozenset({"aki", "kia"})]
    assert trigram_query("[0-9a-f]{16,}") == []
    assert trigram_query("(abcd|xyz)?q+") == []
    assert set(trigram_query("(abcd|xyz)e")) == {frozenset({"abc", "bcd", "cde"}), frozenset({"xyz", "yze"})}
    assert set(trigram_query("api_?key")) == {frozenset({"api", "pi_", "i_k", "_ke", "key"}), frozenset({"api", "pik", "ike", "key"})}
    assert all(any(need <= {"password"[i:i + 3] for i in range(6)} for need in trigram_query(RULES[0].pattern)) for _ in [0])


def test_secrets(spark):
    texts = ["password = hunter2hunter2 and Token:abcdef123456789", "secret = token: abcdefghijklmnop", "\U0001F600é AKIA" + "Z" * 16 + " API_KEY='x'",
             "aa" * 8 + "g" + "0" * 40, None, "", "PASSWD:\t1234567890abcdef", "apikey=" + "a" * 30 + " x " * 10 + "deadbeefdeadbeef",
             " ".join(f"secret=abcdefghijkl{i:04d}" for i in range(3000)), "AKIAAKIA" + "B" * 10, "token\n: zzzzzzzzzzzzz", "k" * 200_000]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, texts[0]), (0, texts[7])]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, spans string")
    out = scan_secrets(docs)
    assert native(out)

    def brute(text):
        found = []
        for rank, r in enumerate(RULES):
            for m in re.compile(r.pattern, re.A).finditer(text or ""):
                if len(m.group(r.group)) >= r.least:
                    found.append((m.start(), rank, r.kind, m.end()))
        return tuple(sorted(found))
    got = Counter((r[0], tuple(tuple(s) for s in r[1])) for r in out.collect())
    assert got == Counter((d, brute(t)) for d, t in rows)
    assert scan_secrets(docs.filter("false")).collect() == []
    only = scan_secrets(docs, (Rule("zed", "z{5,}", 5),)).filter("size(spans) > 0").collect()
    assert len(only) == 1 and only[0]["doc_id"] == 10


def test_content_table():
    t = ContentTable(4)
    for i in range(200):
        t.add(i % 3, f"c{i % 50}".encode(), i, 1)  # hashes that collide
    assert sum(t.count) == 200 and all(f == min(i for i in range(200) if i % 3 == h and f"c{i % 50}".encode() == c)
                                       for h, c, f in zip(t.hash, t.content, t.first))


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 40])
def test_exact(spark, bucket_bytes):
    texts = ["a b", "a  b", "a\t\n b", " a b", "", None, " ", "x" * 100_000, "x" * 100_000, "é", "a b"] + [f"t {i % 7}" for i in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "alone"), (None, "alone"), (1, "a b"), (0, "a b")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, bucket string")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append(d)
    want = []
    for d, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        want.append((d, keep, len(groups[norm(t)]), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert Counter(map(tuple, exact_groups(docs, bucket_bytes=bucket_bytes).collect())) == Counter(want)
    assert exact_groups(docs.filter("false")).collect() == []


def test_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 0, None: 300, "é": 40}
    got = {r["source"]: r for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = ["a", "b", "c", "d", "é", None]
    assert [got[n]["weight"] for n in names] == [1, 2, 3, 1, 2, 3]
    left, share, total = set(names), {}, sum(sizes.values())
    while True:
        level = (total - sum(share.values())) / sum(got[n]["weight"] for n in left)
        full = {n for n in left if got[n]["weight"] * level > 3 * sizes[n]}
        if not full:
            break
        share |= {n: 3 * sizes[n] for n in full}
        left -= full
    for n in names:
        assert got[n]["target"] == pytest.approx(share.get(n, got[n]["weight"] * level))


def test_quota_tree(spark):
    got = split_quotas(spark.createDataFrame([("a", 1000), ("b", 37), ("c", 0)], "_s string, quota long"), 3).collect()
    total, by = Counter(), Counter()
    for r in got:
        total[r["_s"]] += r["quota"]
        by[r["shard"]] += r["quota"]
    assert total == {"a": 1000, "b": 37} and set(by) == set(range(8)) and max(by.values()) - min(by.values()) <= 1


def test_mixing(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), f"s{i % 4}" if i % 9 else None) for i in range(900)]
    rows += [(1000, None, "s0"), (1001, "", "s1"), (None, "w w w", "s2"), (5, rows[5][1], rows[5][2]), (1002, "v " * 3000, "s9")]
    docs = spark.createDataFrame([(*r, 7, "t") for r in rows], "doc_id long, text string, source string, size int, target string")
    out = mix_sources(docs, levels=2)
    assert native(out)
    got = out.collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, _ in rows)
    taken, target, size = Counter(), {}, {}
    places = []
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or len(r["places"]) * r["size"] == r["taken"])
        places += [(p["shard"], p["copy"]) for p in r["places"]]
        assert len({p["copy"] for p in r["places"]}) == len(r["places"])
    for s in target:
        assert target[s] <= 3 * size[s] + 1e-6 and (size[s] == 3000 or abs(taken[s] - target[s]) <= 30)
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert {s for s, _ in places} == {0, 1, 2, 3}
    again = mix_sources(docs.repartition(7), levels=2).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    assert mix_sources(docs.filter("false")).collect() == []


def test_split_law(spark):
    # 64 shards of 150 draws out of 6,400 and 3,200: counts spread like draws without replacement.
    got = split_quotas(spark.createDataFrame([("a", 6400), ("b", 3200)], "_s string, quota long"), 6).filter("_s = 'a'").collect()
    counts = [r["quota"] for r in got]
    spread = sum((c - 100) ** 2 for c in counts) / (150 * 2 / 9)
    assert len(counts) == 64 and sum(counts) == 6400 and 63 - 4 * 11.3 < spread < 63 + 4 * 11.3


def test_mix_takes_what_the_tree_deals(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * 20, f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    words = mix_sources(docs).agg(F.sum("taken")).first()[0]
    assert words == pytest.approx(12000, abs=60)
    # Shards that are dealt nothing give nothing; only the document that fits the gap is left.
    monkeypatch.setattr(mixing, "split_quotas", lambda quotas, levels: split_quotas(quotas, levels).filter("shard < 0"))
    assert mix_sources(docs).agg(F.sum(F.size("places"))).first()[0] <= 3


RULE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_contamination(spark):
    item = " ".join(f"word{i}" for i in range(30))
    items = [(1, item), (2, "Short item é"), (3, "solo"), (4, ""), (5, None), (None, "never matched ever"), (6, item), (7, "aa bb cc dd " * 6)]
    part = " ".join(item.split()[5:20])
    texts = ["x " * 100 + part, part.upper().replace(" ", "--"), "the short ITEM é! yes", "solo", "so lo", None, "", "y " * 400 + item + " z",
             " ".join(item.split()[:12]), "aa bb cc dd " * 50, "never matched ever", "w " * 60_000 + part, "É short item", "q " * 59 + "solo"]
    rows = list(enumerate(texts)) + [(None, texts[0]), (0, texts[0]), (0, texts[3])]
    docs = spark.createDataFrame([(d, t, 3, "k") for d, t in rows], "doc_id long, text string, n_hit int, _met string")
    bench = spark.createDataFrame([(d, t, 0) for d, t in items], "item_id long, text string, n_words int")
    out = contaminated(docs, bench)
    assert native(out)
    windows = {}
    for d, t in items:
        w = RULE.findall(lowered(t))
        if d is not None and w:
            size = min(13, len(w))
            for i in range(len(w) - size + 1):
                windows.setdefault(tuple(w[i:i + size]), set()).add(str(d))
    want = []
    for d, t in rows:
        w = RULE.findall(lowered(t))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if (x := tuple(w[i:i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[x]
        want.append((d, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    got = out.collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got) == Counter(want)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and native(kept)
    assert Counter((r[0], r[1]) for r in kept.collect()) == Counter((d, t) for (d, t), w in zip(rows, want) if not w[4])
    assert contaminated(docs.filter("false"), bench).collect() == []
    assert all(not r["contaminated"] for r in contaminated(docs, bench.filter("false")).collect())


def test_what_rows_meet_is_numbers(spark, monkeypatch):
    """Tables that grow with the rows hold no words and are not broadcast, and results are the same by shuffle joins."""
    words = [f"w{i}" for i in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[5:30])), (3, "w1 w2")], "item_id long, text string")
    rows = [(i, " ".join(words[i % 7:i % 7 + 25])) for i in range(30)] + [(None, " ".join(words[:14])), (3, None), (4, "w1 W2"), (4, "w1 W2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, store = {}, decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name, *a: kept.setdefault(name, store(df, name, *a)))
    want = Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in contaminated(docs, bench).collect())
    assert "string" not in kept["candidates"].schema.simpleString() and "string" not in kept["seen-shingles"].schema.simpleString()
    kept.clear()
    for limit in ("SHINGLES", "BROADCAST", "PACKED"):
        monkeypatch.setattr(decontaminate, limit, 0)
    out = contaminated(docs, bench)
    assert Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in out.collect()) == want
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString() and sum(r[2] > 0 for r in want) > 20
