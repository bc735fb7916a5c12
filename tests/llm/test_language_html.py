"""Language field, page extraction, the pipeline and the registered queries."""

import zlib
import time
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from twinledger.llm import queries, windows
from twinledger.llm.html_extract import MAIN, OPEN, OUT, extract_text, host_windows, page_blocks
from twinledger.llm.language import SLOTS, UNKNOWN, _features, identify, keep_identified, labelled_sample, marginals

SF = "/root/testdata/sf0.001"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    moves = rng.normal(size=(3, 3))
    lengths = np.array([1, 4, 5])
    scores = rng.normal(size=(10, 3))
    got = marginals(scores, lengths, moves)[0]
    low = 0
    for n in lengths:
        p = np.zeros((n, 3))
        for path in np.ndindex(*(3,) * n):
            e = sum(scores[low + i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            first = np.logaddexp.reduce(moves[:, path[0]])  # every label may stand ahead of the first
            for i, y in enumerate(path):
                p[i, y] += np.exp(e + first)
        assert np.allclose(got[low:low + n], p / p.sum(axis=1, keepdims=True))
        low += n


def test_long_chains_equal_step_by_step():
    rng = np.random.default_rng(4)
    moves, scores = rng.normal(size=(4, 4)), rng.normal(size=(500, 4)) * 3
    got = marginals(scores, np.array([500]), moves)[0]
    a = np.exp(moves)
    forward, backward = np.ones((501, 4)), np.ones((500, 4))
    for t in range(500):
        x = (forward[t] @ a) * np.exp(scores[t])
        forward[t + 1] = x / x.sum()
    for t in range(498, -1, -1):
        x = a @ (np.exp(scores[t + 1]) * backward[t + 1])
        backward[t] = x / x.sum()
    want = forward[1:] * backward
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True))


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 !? --", "de", "s", 5), (10**6 + 2, "", None, None, 0),
                                 (None, "the and of with that", None, "s", 5)], docs.schema)
    rows = docs.unionByName(odd)
    got = identify(rows.withColumn("score", rows["n_chars"])).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(got) == rows.count() and all(r["held_out"] for r in held) and len(held) > 20
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert {by[10**6 + i]["lang_pred"] for i in range(3)} == {UNKNOWN} and by[None]["held_out"] and by[None]["lang_pred"] == "en"
    kept = keep_identified(rows)
    assert kept.columns == rows.columns and 10**6 not in {r["doc_id"] for r in kept.collect()}


def test_features_read_whole_words():
    long = "ab" * 20
    assert len(_features(long)) == len(long) + 7
    assert set(_features(long + "xyz" + long)) - set(_features(long + long)) > {crc % SLOTS for crc in (zlib.crc32(b"gxyz"), zlib.crc32(b"gbxy"))}


def test_sample_is_the_first_of_each_label_by_hash(spark):
    rows = [(i, f"text {i} " * 9, "abc"[i % 3]) for i in range(600)]
    # One id with many texts, one row many times, rows that are never learned from.
    rows += [(1, f"other {i}", "a") for i in range(300)] + [(2, "again", "b")] * 300
    rows += [(None, "no id", "a"), (3, None, "a"), (4, "no label", None), (7, "alone", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashed = docs.selectExpr("*", "xxhash64(11, doc_id) o", "xxhash64(text) t", "crc32(cast(string(doc_id) as binary)) % 5 = 0 out").collect()
    for per_label in (1, 40, 1000):
        want = []
        for label in "abcd":
            known = sorted((r["o"], r["t"], r["text"][:12]) for r in hashed if r["lang"] == label and r["text"] and r["out"] is False)
            want += [(x[2], label) for x in known[:per_label]]
        assert labelled_sample(docs, "text", "lang", "doc_id", per_label, 12) == want


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in identify(docs).collect()] == [(UNKNOWN, 0.0)]
    assert identify(docs.filter("false")).collect() == []


def test_blocks():
    page = ("<html><head><title>t</title><script>var a='</p>'</script></head><body><nav><a href=x>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><header><h1>Head&amp;line</h1></header><p><b>One<br>two  <i>th</i>ree<p>Four"
            "<div class=ad>Buy</div><section id='comments'><p>first!</p></section><ul><li>a<li>b</ul><footer>by me</footer></article>"
            "<!-- <p>no</p> --><div>Outside &lt;kept&gt;</div><footer>&copy;</footer>")
    got = [(k, t) for k, t, _ in page_blocks(page)]
    assert got == [(OUT, "Home"), (OUT, "We use cookies"), (MAIN, "Head&line"), (MAIN, "One two three"), (MAIN, "Four"), (OUT, "Buy"), (OUT, "first!"),
                   (MAIN, "a"), (MAIN, "b"), (OUT, "by me"), (OPEN, "Outside <kept>"), (OUT, "©")]
    assert page_blocks("") == [] and page_blocks("<") == [(OPEN, "<", 0.0)]


def test_scripts_end_at_their_own_end_tag():
    for script in ("for(i=0;i<n;i++){f(i)}", "if(a<b){s='<p>';t=\"it's\"}", "<!-- x<y", "var s='</scripted>'"):
        for end in ("</script>", "</SCRIPT >"):
            page = f"<body><script>{script}{end}<article><p>Text</p></article><script>g()</script><p>after"
            assert [(k, t) for k, t, _ in page_blocks(page)] == [(MAIN, "Text"), (OPEN, "after")], script
    assert page_blocks("<p>a<style>b<c") == [(OPEN, "a", 0.0)]


def test_elements_around_the_only_article_do_not_decide():
    kinds = lambda page: [(k, t) for k, t, _ in page_blocks(page)]
    assert kinds("<form><article><p>Text</p></article><p>x</p></form>") == [(MAIN, "Text"), (OPEN, "x")]
    assert kinds("<div role=dialog><main>Story</main></div><footer>f</footer>") == [(MAIN, "Story"), (OUT, "f")]
    assert kinds("<nav><a>n</a><article>Art</article>") == [(OPEN, "n"), (MAIN, "Art")]
    assert kinds("<nav><article>teaser</article></nav><article>Art</article>") == [(OUT, "teaser"), (MAIN, "Art")]
    assert kinds("<p hidden>no</p><article>E <math><mi>x</mi>=1</math></article>") == [(OUT, "no"), (MAIN, "E x=1")]
    assert kinds("<p class='hidden x'>a</p><p data-x=hidden>b</p><p style='visibility:hidden'>c</p>") == [(OPEN, "a"), (OPEN, "b"), (OUT, "c")]
    assert kinds("<div class=search><p>A story</p></div>") == [(OPEN, "A story")]
    assert kinds("<nav>menu</nav>") == [(OUT, "menu")]


@pytest.mark.parametrize("page", ["<" + "a" * 10**6, "<b " * 333_333, '<a href="x ' * 90_000, "<a '\"" * 200_000, "<!" * 500_000, "<div>" * 200_000, "<b>" * 150_000 + "</span>" * 150_000,
                                  "<div class=ad>" * 70_000, "<b>" * 100_000 + "<hr>" * 200_000, "<a " + "x-" * 500_000 + ">", "<a \"'" * 100_000 + ">" * 100_000])
def test_broken_markup_takes_time_in_proportion(page):
    start = time.process_time()
    page_blocks(page)
    assert time.process_time() - start < 10


def test_tags_end_outside_of_quotes():
    kinds = lambda page: [(k, t) for k, t, _ in page_blocks(page)]
    assert kinds("<p title='a>b'>x<a href=\"<c>\">y</a>") == [(OPEN, "xy")]
    assert kinds("a < b <p>c<3 <br d='") == [(OPEN, "a < b"), (OPEN, "c<3 <br d='")]
    assert kinds("x<!-- <p>n</p>") == [(OPEN, "x")] and kinds("x<!y") == [(OPEN, "x")]


def test_names_of_wrappers_do_not_decide():
    kinds = lambda page: [(k, t) for k, t, _ in page_blocks(page)]
    for name in ("class='content no-sidebar'", "class=has-sidebar", "class=layout-sidebar-right", "id=search-page", "class=search", "id=banner"):
        assert kinds(f"<body {name}><div {name}><article><p>Text</p></article></div>") == [(MAIN, "Text")], name
        assert kinds(f"<div {name}><div role=main>Text</div></div><div class=sidebar>Side</div>") == [(MAIN, "Text"), (OUT, "Side")], name
    assert kinds("<article><div class=article-header><h1>Head</h1></div><div class='entry-header'>By</div></article>") == [(MAIN, "Head"), (MAIN, "By")]
    assert kinds("<div class=no-sidebar>Open</div><div class=cookie-notice>C</div>") == [(OPEN, "Open"), (OUT, "C")]
    assert kinds("<article>A<section id=comments><article>first!</article></section></article>") == [(MAIN, "A"), (OUT, "first!")]
    assert kinds("<div class=sidebar><p>x</p><nav>n<article>y</article></nav></div>") == [(OUT, "x"), (OUT, "n"), (OUT, "y")]


def test_extraction(spark):
    def page(i):
        return (f"<body><div>Welcome to our big site about the cats and dogs of town</div><div><p>Unique text number {i} about thing {i * 7} with "
                f"words {i * 13} {i * 17} and {i * 31} more</p></div><div><a href=1>one link</a> <a href=2>more</a></div><div>All rights reserved by the big site about "
                "cats and dogs company</div></body>")
    rows = [(i, f"http://h.example/{i}", page(i), 1) for i in range(6)]
    rows += [(10, "https://other.example/", page(10), 1), (11, None, None, 1), (12, "x", "", 1), (None, "http://z", "<article>Kept</article> not", 1),
             (13, "http://z/1", "<article><p>Copied article of many words that is the same everywhere you look</p></article>", 1),
             (14, "http://z/2", "<article><p>Copied article of many words that is the same everywhere you look</p></article>", 1),
             (0, "http://h.example/0", page(0), 1)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    own = lambda i: f"Unique text number {i} about thing {i * 7} with words {i * 13} {i * 17} and {i * 31} more"
    copied = "Copied article of many words that is the same everywhere you look"
    want = [(i, own(i)) for i in range(6)] + [(0, own(0)), (11, ""), (12, ""), (None, "Kept"), (13, copied), (14, copied)]
    want.append((10, "\n\n".join(["Welcome to our big site about the cats and dogs of town", own(10), "All rights reserved by the big site about cats and dogs company"])))
    assert Counter((r[0], r[2]) for r in got) == Counter(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def _texts(spark, rows):
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in got}


def _own(i):
    return f"Unique text number {i} about thing {i * 7} with words {i * 13} {i * 17} and {i * 31} more"


def test_copied_pages_and_shared_paragraphs_stay(spark):
    rights = "All rights reserved by the big site about cats and dogs company"
    quote = "A paragraph of a dozen words or so that two articles of this host share with each other"
    cited = "".join(f"<li><a href={i}>Smith and Jones {i}</a></li>" for i in range(5))
    rows = [(i, f"http://h/{i}", f"<div><p>{_own(i)}</p></div><div>{rights}</div>") for i in range(8)]
    rows += [(20 + i, f"http://h/20?v={i}", f"<nav>n{i}</nav><div>{_own(20)}</div><div>{rights}</div>") for i in range(6)]
    rows += [(30 + i, f"http://h/{30 + i}", f"<p>{_own(30 + i)}<p>{quote}<div>{rights}</div>") for i in range(2)]
    rows += [(40, "http://h/40", f"<p>{_own(40)}<ul>{cited}</ul><div>{rights}</div>")]
    want = {i: _own(i) for i in range(8)} | {20 + i: _own(20) for i in range(6)} | {30 + i: f"{_own(30 + i)}\n\n{quote}" for i in range(2)}
    want[40] = "\n\n".join([_own(40), *(f"Smith and Jones {i}" for i in range(5))])
    assert _texts(spark, rows) == want


def test_host_decides_on_marked_articles_too(spark):
    rights = "All rights reserved by the big site about cats and dogs company"
    beside = "The second half of this article stands outside of what is marked"
    copy = "Copied article of many words that is the same everywhere you look"
    rows = [(i, f"http://h/{i}", f"<main><p>{_own(i)}</p><div>{rights}</div></main><p>{rights}</p><p>menu {i}</p>") for i in range(6)]
    rows += [(9, "http://h/9", f"<article><p>{_own(9)}</p></article><p>{beside}</p><div>{rights}</div>")]
    rows += [(10 + i, f"http://h/{10 + i}", f"<nav>n{i}</nav><article><p>{copy}</p></article>") for i in range(5)]
    rows += [(20 + i, f"http://z/{i}", f"<article><p>{copy}</p></article><p>Beside every copy stands another paragraph, which is number {i}") for i in range(5)]
    got = _texts(spark, rows)
    assert {i: got[i] for i in range(6)} == {i: _own(i) for i in range(6)} and got[9] == f"{_own(9)}\n\n{beside}"
    assert {got[10 + i] for i in range(5)} == {copy} and all(got[20 + i].startswith(copy) for i in range(5))


def test_shared_runs_are_counted_exactly(spark):
    """A window in ever other company, many times in one page, counts that page once."""
    line = "one two three four five six seven eight nine ten"
    rows = [(i, f"http://h/{i}", f"<p>{_own(i)}<p>{line}") for i in range(2)]
    rows += [(2, "http://h/2", "".join(f"<p>{line}<p>{_own(50 + i)}" for i in range(6)))]
    rows += [(5 + i, f"http://g/{i}", f"<p>{_own(i)}<p>{line}<p>{_own(i + 20)}") for i in range(2)]
    few = _texts(spark, rows[1:])
    assert all(line in text for text in few.values())
    more = _texts(spark, rows)
    assert [i for i, text in sorted(more.items()) if line in text] == [5, 6]


def test_host_windows_make_few_segments_and_meet():
    rng = np.random.default_rng(3)
    codes = [rng.integers(1, 1 << 40, 20000).astype(np.uint64)]
    spec = host_windows(8)
    found = list(windows.segments(codes, spec.length, spec.gram))
    assert sum(len(s.start) for s in found) < 0.31 * sum(int(s.windows.sum()) for s in found)


def test_near_dedup_decides_per_row(spark):
    text = lambda n, end: " ".join(f"w{n}x{i}" for i in range(60)) + end
    rows = [(3, text(0, "")), (5, text(0, " more")), (5, text(1, "")), (5, text(1, "")), (None, text(2, "")), (None, text(2, " more")), (None, text(1, " z")),
            (None, text(4, "")), (None, ""), (None, ""), (6, None), (5, text(5, ""))]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    got = Counter((r[0], r[1]) for r in out.collect())
    near = [got.pop((None, text(2, end)), 0) for end in ("", " more")]
    assert sorted(near) == [0, 1]
    assert got == Counter([(3, text(0, "")), (5, text(1, "")), (None, text(4, "")), (None, ""), (None, ""), (6, None), (5, text(5, ""))])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns and docs.schema == before.schema, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > counts[0] / 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == counts[-1]
    assert Counter(map(str, corpus_pipeline.run(spark, SF).collect())) == Counter(map(str, last))
    none = before.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    from checks import compare
    con = compare.connect(SF)
    df = queries.QUERIES[name](spark, SF)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(queries.SQL[name])
    assert got == compare.rows_of([d[0] for d in res.description], res.fetchall())


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
