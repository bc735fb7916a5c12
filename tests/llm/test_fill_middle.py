"""Fill-in-the-middle against a plain version, and round trips."""

import hashlib
import random

import numpy as np
import pytest

from twinledger.llm import fill_middle
from twinledger.llm.fill_middle import fill_in_middle, restore_middle

CASES = ["", None, "a", "é", "<P>", "x<S>y", "<M", "a<", "<", ">", "S><P", "日本語のテキスト" * 9, "á\U0001F600b" * 30, " \n\t ", "plain words " * 50, "<PSM>" * 7, "P><", "\x00\x01"]


def plainly(doc_id, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}", text


def rows(seed=2):
    rng = random.Random(seed)
    out = [(i, c) for i, c in enumerate(CASES)] + [(100 + i, c) for i, c in enumerate(CASES)]
    out += [(i, "".join(rng.choice("ab<>PSMé日\U0001F600 \n") for _ in range(rng.randint(0, 40)))) for i in range(-200, 0)]
    return out + [(7, "again"), (7, "again"), (7, "other"), (None, "no id"), (None, None), (1 << 62, "far")]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_scatter_and_gather(monkeypatch, piece):
    monkeypatch.setattr(fill_middle, "SLICE", piece)
    made = [plainly(d, t) for d, t in rows()]
    data = np.frombuffer("".join(m[6] for m in made).encode(), dtype=np.uint8)
    ends = np.cumsum([len(m[6].encode()) for m in made])
    begins = ends - [len(m[6].encode()) for m in made]
    before = fill_middle.points_before(data, np.append(begins, len(data)))
    assert np.diff(before).tolist() == [m[1] for m in made]
    kind = np.array([("plain", "psm", "spm").index(m[2]) for m in made])
    cut = lambda f: np.minimum(fill_middle.bytes_of(data, before[:-1] + np.array([f(m) for m in made])), ends)
    out, stops = fill_middle.scatter(data, ends, cut(lambda m: m[3] or 0), cut(lambda m: (m[3] or 0) + (m[4] or 0)), kind)
    assert out.tobytes().decode() == "".join(m[5] for m in made)
    text, text_ends = fill_middle.gather(out, stops, kind)
    assert text.tobytes() == data.tobytes() and text_ends.tolist() == ends.tolist()


def test_fill_in_middle(spark):
    docs = spark.createDataFrame([(d, t, "x", -1) for d, t in rows()], "doc_id long, text string, output string, _form int")
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    got = fill_in_middle(docs, carry=True).collect()
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted((plainly(d, t) for d, t in rows()), key=key)
    assert all((r["row"]["text"] or "") == r["output"] if r["form"] == "plain" else r["row"]["output"] == "x" for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_long_text_and_nothing(spark):
    long = "wörter und mehr " * 500_000
    docs = spark.createDataFrame([(d, long) for d in (1, 2, 3)], "doc_id long, text string")
    assert {tuple(r) for r in fill_in_middle(docs).collect()} == {plainly(d, long) for d in (1, 2, 3)}
    assert fill_in_middle(docs.limit(0)).collect() == []
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_restore(spark):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows()], "doc_id long, text string, restored string")
    made = fill_in_middle(docs, plain=0, spm=50).drop("restored")
    back = restore_middle(made).collect()
    assert sorted((r["doc_id"] or 0, r["restored"]) for r in back) == sorted((d or 0, t or "") for d, t in rows())
    assert all(m in r["output"] for r in back if r["form"] != "plain" for m in ("<P>", "<S>", "<M>"))
    odd = spark.createDataFrame([(None, "psm"), ("a<P>", None), ("a<P>", "plain")], "output string, form string")
    assert [r["restored"] for r in restore_middle(odd).collect()] == [None, None, "a<P>"]
