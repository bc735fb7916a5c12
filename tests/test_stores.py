"""Stores that stop on the way, deep graphs, literals, many patterns, samples, bucketed targets, arrivals."""

import ast
import fnmatch
import json
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from checks import loading as ld, stores as st
from twinledger import session
from twinledger.functions import values
from twinledger.functions.literals import literal_json
from twinledger.model import rows
from twinledger.operators import graph, parity, patterns, ranking, resolve
from twinledger.operators.rules import RULE_COLUMNS
from twinledger.plans import execute, prepare
from twinledger.session import work_folder
from twinledger.sources import extract as ex, manifest, paged, result_store, store
from twinledger.streaming import jobs

SF = "/root/testdata/sf0.001"
LONG = "env obj record_id external_id field value"


# --- graphs ----------------------------------------------------------------------------------


def peeled(n, edges):
    needs = {i: {b for a, b in edges if a == i and b != i} for i in range(n)}
    level, left = {}, set(needs)
    while True:
        free = [x for x in left if all(y in level for y in needs[x])]
        if not free:
            return level
        level |= {x: max((level[y] + 1 for y in needs[x]), default=0) for x in free}
        left -= set(free)


def test_waves_leave_only_what_the_result_reads(spark):
    """Rounds write packed tables, which go when the next round is there, and shuffle files go with their job."""
    folder, name = session.shared_folder(spark).removeprefix("file:"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    listed = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rdds = lambda: sum(d.startswith("rdd-") for _, found, _ in os.walk(folder) for d in found)
    before, files, old = listed(), rdds(), spark.conf.get(name, "false")
    records = spark.range(300).selectExpr("'A' as object", "cast(id as string) as record_id")
    edges = spark.range(1, 300).selectExpr("'A' as object", "cast(id as string) as record_id", "'A' as needs_object", "cast(id - 1 as string) as needs_id")
    out = graph.load_waves(records, edges)
    left = sorted(f.rsplit("-", 1)[0] for f in listed() - before)
    assert set(left) == {"names", "nodes", "known"} and rdds() == files and spark.conf.get(name, "false") == old
    assert sorted((int(r["record_id"]), r["wave"]) for r in out.collect()) == [(i, i) for i in range(300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_equal_the_peel(spark, seed):
    rng, n = random.Random(seed), 50
    edges = [(i, rng.randrange(i)) for i in range(1, n) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
    edges += [(rng.randrange(5, 20), rng.randrange(25, 40)) for _ in range(seed - 1)] + [(30, 31), (31, 32), (32, 30)][:3 * (seed - 1)]
    edges = [e for e in edges if e[0] != e[1]]
    out, cyclic = graph.levels(spark.createDataFrame([(i,) for i in range(n)], "node int"), spark.createDataFrame(edges, "node int, needs int"))
    want = peeled(n, edges)
    assert {r.node: r.level for r in out.collect()} == want
    assert {r.node for r in cyclic.collect()} == set(range(n)) - set(want)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, real = [], graph.skew_join
    monkeypatch.setattr(graph, "skew_join", lambda a, b, on, how="left": rounds.append(how) or real(a, b, on, how))
    out, cyclic = graph.levels(spark.range(10_000).toDF("node"), spark.range(1, 10_000).selectExpr("id as node", "id - 1 as needs"))
    assert out.filter("level <> node").isEmpty() and out.count() == 10_000 and cyclic.isEmpty()
    assert rounds.count("inner") <= 20


def test_graphs_of_nothing(spark):
    none = spark.createDataFrame([], "node int, needs int")
    out, cyclic = graph.levels(none.select("node"), none)
    assert out.isEmpty() and cyclic.isEmpty()
    out, cyclic = graph.levels(spark.createDataFrame([(1,), (1,)], "node int"), none)
    assert [tuple(r) for r in out.collect()] == [(1, 0)]


# --- diff store --------------------------------------------------------------------------------


def sides(table, changed):
    new = table(LONG, [("N", o, f"N{o}", "1", "f", "x") for o in "AB"])
    old = table(LONG, [("O", o, "1", None, "f", "y" if o in changed else "x") for o in "AB"])
    return ex.with_bucket(new, "new"), ex.with_bucket(old, "old")


def stored(table, path, changed, config="a"):
    new, old = sides(table, changed)
    return store.write_paired(parity.record_parity(new, old).paired, new.unionByName(old), path, config)


def test_a_run_that_stops_ahead_of_its_manifest_changes_nothing(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "diff")
    assert store.read_paired(spark, path).collect() == [] and store.manifest_rows(spark, path).collect() == []
    done = stored(table, path, "AB")
    assert (done.record_rows, done.field_rows) == (2, 2)
    monkeypatch.setattr(manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        stored(table, path, "")
    monkeypatch.undo()
    assert {r.obj for r in store.read_paired(spark, path).collect()} == {"A", "B"}
    new, _ = sides(table, "")
    assert store.skip_done(new, store.done_buckets(spark, path, "a")).isEmpty()
    assert len(store.drop_dead_runs(spark, path)) == 1 and store.drop_dead_runs(spark, path) == []
    assert stored(table, path, "B").record_rows == 1
    assert [r.obj for r in store.read_paired(spark, path).collect()] == ["B"]
    assert store.read_paired(spark, path, objects=["A"]).collect() == []
    assert len(store.drop_dead_runs(spark, path)) == 1 and store.read_paired(spark, path).count() == 1


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "m")
    one = spark.createDataFrame([("x",)], "name string")
    assert manifest.last(spark, path, "name string") == (0, None)
    assert manifest.commit(one, path, 0) == 1
    with pytest.raises(manifest.Conflict):
        manifest.commit(one, path, 0)
    assert manifest.commit(one.limit(0), path, 1) == 2
    number, live = manifest.last(spark, path, "name string")
    assert number == 2 and live.collect() == []


def test_record_parts_of_some_objects(spark, table, tmp_path):
    path = str(tmp_path / "records")
    recs = lambda changed: parity.record_parity(*sides(table, changed)).records
    seen = lambda: {r.obj for r in store.read_record_parts(spark, path).collect()}
    assert seen() == set()
    store.write_record_parts(recs("AB"), path)
    store.write_record_parts(recs("").filter("obj = 'A'"), path, objects=["A"])
    assert seen() == {"B"}
    with pytest.raises(ValueError):
        store.write_record_parts(recs("AB"), path, objects=["A"])
    assert seen() == {"B"}
    store.write_record_parts(recs("A"), path)
    assert seen() == {"A"}


# --- reading in pages ---------------------------------------------------------------------------


def test_pages_are_taken_up_again(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    data = [(None if i % 40 == 0 else rng.randrange(300), f"k{i % 70}", i) for i in range(400)]
    df = spark.createDataFrame(data, "id long, name string, n int").repartition(4)
    for column in ("id", "name"):
        base = str(tmp_path / column)
        pages = paged.plan_pages(df, column, 50, f"{base}/plan", pages_a_step=2)
        assert 6 <= pages <= 9
        assert not paged.read_paged(df, column, f"{base}/plan", f"{base}/out", f"{base}/cp", steps=1)
        some = paged.paged_rows(spark, f"{base}/out", df.schema).count()
        assert 0 < some < 400
        # A step that fails when its rows are written is read again.
        broken = df.withColumn("n", F.when(F.col("n") >= 0, F.expr("raise_error('lost')")).otherwise(F.col("n")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            paged.read_paged(broken, column, f"{base}/plan", f"{base}/out", f"{base}/cp")
        assert paged.read_paged(df, column, f"{base}/plan", f"{base}/out", f"{base}/cp")
        assert sorted(r.n for r in paged.paged_rows(spark, f"{base}/out", df.schema).collect()) == list(range(400))
    assert paged.plan_pages(df.limit(0), "id", 5, str(tmp_path / "none")) == 1
    with pytest.raises(ValueError):
        paged.page_bounds(df, "id", 0)


# --- literals, patterns, flags -------------------------------------------------------------------


def literal(rng, depth):
    def text():
        q = rng.choice("'\"")
        parts = [rng.choice(["a", "it's", 'say "x"', "\\n", "\\\\", "\\'", '\\"', "\\x41", "\\u00e9", "\\U0001F600", "\\101", "é", " ", "\\t", "\\a", "[", ",", ":", "{"]) for _ in range(rng.randint(0, 5))]
        return rng.choice(["", "u"]) + q + "".join(p if q not in p or p.startswith("\\") else p.replace(q, "") for p in parts) + q
    kind = rng.random()
    if depth == 0 or kind < .5:
        return rng.choice([text(), text() + " " + text(), rng.choice(["None", "True", "False", "1", "-2", "+3", "1.5", "-.5", "2.", "1e3", "1_000", "0x1F", "0b101", "0o17", "0"])])
    some = [literal(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    if kind < .7:
        return "[" + ", ".join(some) + "]"
    if kind < .8:
        return "(" + ",".join(some) + ("," if len(some) == 1 else "") + ")"
    return "{" + ", ".join(f"'k{i}': {x}" for i, x in enumerate(some)) + "}" if kind < .95 else f"[{literal(rng, depth - 1)} , ]"


def test_literals_read_as_python_reads_them(spark):
    rng = random.Random(8)
    good = [literal(rng, 3) for _ in range(300)]
    bad = ["[1 2]", "[", "]", "{'a'}", "{'a':}", "{'a' 1}", "['a','b'", "x", "[x]", "'a", "[1,,2]", "[,1]", "007", "1__0", "", "  ", "[1]]", "{'a':1,'b'}", ":", "[1;2]", "{,}", "(,)",
           "'\\x4'", "1,2", "[None None]", "['a' 1]", "[1:2]", "--1"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string").orderBy("i").select(literal_json(F.col("t"))).collect()]
    plain = lambda x: [plain(y) for y in x] if isinstance(x, (list, tuple)) else {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else x
    for text, told in zip(good, got):
        assert json.loads(told) == plain(ast.literal_eval(text.strip())), text
    assert set(got[len(good):]) == {None}


def test_ten_thousand_patterns(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    names = [(rng.choice(["A", "B", "Ab"]), word(rng.randint(0, 9))) for _ in range(300)] + [(None, "abc"), ("A", None)]
    make = [lambda: word(4) + "*", lambda: "*" + word(4), lambda: f"{rng.choice('AB')}.{word(3)}?*", lambda: f"A*.{word(2)}*{word(2)}", lambda: word(5),
            lambda: f"B.*{word(3)}*", lambda: f"[a-c]{word(3)}*", lambda: f"{word(2)}[!{word(1)}]*{word(1)}", lambda: " "]
    specs = [rng.choice(make)() for _ in range(10_000)] + ["*e?d*a*", "A.*"]
    found = patterns.first_specs(spark.createDataFrame(names, "obj string, field string"), patterns.listed(spark, specs))
    got = {(r.obj, r.field): r.spec for r in found.collect()}

    def first(obj, field):
        for s in specs:
            s = s.strip()
            o, f = s.split(".", 1) if "." in s else ("*", s)
            if s and fnmatch.fnmatchcase(obj or "", o) and fnmatch.fnmatchcase(field or "", f):
                return s
    assert got == {n: first(*n) for n in names if first(*n)}
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_flags(spark):
    df = spark.sql("select parse_json(j) as v, e from values ('true', array()), ('false', array()), ('\" TRUE \"', array('x')), ('1', array()), ('1', array('x')), ('0', null), ('null', array()), "
                   "('[]', array()), ('[0]', array()), (null, array()) as t(j, e)")
    assert [r[0] for r in df.select(values.outcome(F.col("v"), T.VariantType(), F.col("e"))).collect()] == [True, False, True, True, False, False, False, False, True, False]


# --- samples, targets -----------------------------------------------------------------------------


def test_merged_top(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FAN", 3)
    df = spark.range(0, 30_000, 1, 40).selectExpr("'g' as g", "id", "md5(cast(id as string)) as h")
    got = [r.id for r in ranking.merged_top(df, ["g"], ["h"], 5000).collect()]
    assert sorted(got) == sorted(r.id for r in df.orderBy("h").limit(5000).collect())
    assert ranking.seeded_sample(df, ["g"], ["id"], 5000).count() == 5000
    assert ranking.top_per_group(df.withColumn("g", F.col("id") % 7), ["g"], ["id"], 200).filter("id >= 1400").isEmpty()


def test_waves_do_not_shuffle_the_target(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = execute.held_target(ld.new_target(spark, SF))
        ops = spark.createDataFrame([("Sale", "S", "5", "N5", "data_gap", "update", [], [], "ready", None)], execute_schema())
        checked = execute.outcomes(ops, held.only(["Sale"]))
        for made in (checked, execute.merge_into(held.rows, checked)):
            plan = made._jdf.queryExecution().executedPlan().toString().split("\n")
            depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
            scans = [i for i, line in enumerate(plan) if "FileScan" in line and "held_" in line]
            assert scans
            for i in scans:
                level, above = depth(plan[i]), []
                for line in reversed(plan[:i]):  # up to the join that meets the target
                    if depth(line) < level:
                        level = depth(line)
                        above.append(line)
                        if "Join" in line:
                            break
                assert not any("Exchange" in line for line in above), above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def execute_schema():
    entries = "array<struct<name:string,ext_field:string,value:string>>"
    return (f"target_object string, source_object string, source_record_id string, target_record_id string, change_type string, operation string, entries {entries}, "
            "skipped array<string>, status string, message string")


@pytest.mark.parametrize("name", ["plan_operations", "apply_operations", "map_payload"])
def test_load_plans_shuffle_little(spark, name):
    from __spark_entry__ import queries
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") <= 8


def test_references_of_repeated_and_blank_records(spark):
    entry = lambda n, v, e="External_Id__c": {"name": n, "ext_field": e, "value": v}
    data = [("Sale", "1", [entry("Buyer", "a"), entry("Keeper", None), entry("Other", "z"), entry("BuyerId", "old", None)], ["s"], 1), ("Sale", "1", [entry("Amount", "2", None)], [], 2),
            ("Sale", None, [entry("Buyer", "b")], [], 3), ("Lead", "4", [entry("Buyer", "a")], ["t"], 4)]
    work = spark.createDataFrame(data, f"target_object string, source_record_id string, entries {execute_schema().split('entries ')[1].split(', skipped')[0]}, skipped array<string>, n int")
    ids = spark.createDataFrame([("Lead", "a", "L", 1), ("Account", "a", "A", 1), ("Account", "a", "B", 0), ("Lead", "b", "M", 1)], "object string, ext_id string, target_id string, origin int")
    got = {r.n: (sorted((e.name, e.value) for e in r.entries), r.skipped) for r in resolve.resolve_references(work, ld.field_catalog(spark), ids).collect()}
    assert got[1] == ([("BuyerId", "B"), ("KeeperId", None), ("Other", "z")], ["s"]) and got[2] == ([("Amount", "2")], [])
    assert got[3] == ([("BuyerId", "M")], []) and got[4] == ([("Buyer", "a")], ["t"])


def test_a_load_is_taken_up_again(spark):
    work, target, options = st.deals(spark, SF)
    work = work.filter("cast(source_record_id as int) < 60")
    kept = work_folder(spark, "kept")
    whole = execute.run_load(work, target, **options)
    first = execute.run_load(work, target, only=rows(spark, ["object"], [("Contact",)]), store=kept, **options)
    second = execute.run_load(work, first.target, store=kept, **options)
    assert second.results.filter("target_object = 'Contact'").isEmpty()
    told = lambda df: sorted((r.target_object, r.source_record_id, r.target_record_id, r.operation, r.success) for r in df.collect())
    assert told(result_store.last_outcomes(spark, kept)) == told(whole.results)
    assert {(r.object, r.record_id) for r in second.target.collect()} == {(r.object, r.record_id) for r in whole.target.collect()}
    dry = execute.run_load(work, target, dry_run=True, store=kept, results=whole.results.limit(0), **{**options, "sequence": None})
    assert dry.results.filter("dry_run <> 'TRUE'").isEmpty()
    with pytest.raises(ValueError):
        execute.run_load(work.limit(0), target, link=None, **options)


def test_malformed_payloads_are_put_aside(spark):
    df = spark.createDataFrame([(1, '{"a":1}', None), (2, "[1]", "{}"), (3, " ", "x")], "n int, p string, q string")
    good, bad = prepare.split_malformed(df, ["p", "q"])
    assert [r.n for r in good.collect()] == [1] and sorted(r.n for r in bad.collect()) == [2, 3]
    assert rows(spark, RULE_COLUMNS, []).count() == 0


# --- streams -----------------------------------------------------------------------------------------


def test_arrivals(spark, tmp_path):
    base = str(tmp_path)
    schema = "target_object string, source_record_id string, at timestamp, size long, note string"

    def run(work, results=()):
        spark.createDataFrame(work, schema).selectExpr("*").coalesce(1).write.mode("append").parquet(f"{base}/in")
        if results:
            spark.createDataFrame(results, "target_object string, source_record_id string, success string").write.mode("append").parquet(f"{base}/results")
        arriving = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.fresh_work(arriving, jobs.result_keys(spark, f"{base}/results"), f"{base}/out", f"{base}/cp", ["size", "note"]).awaitTermination()
        return sorted((r.source_record_id, r.size, r.note) for r in spark.read.parquet(f"{base}/out").collect())
    big = (1 << 60) + 1
    assert run([("A", "1", None, big, "x"), ("A", "1", None, big - 1, "z"), ("A", "1", None, big - 1, "y"), ("A", None, None, 1, "x"), ("A", "2", None, None, None), ("A", "2", None, 0, "a"),
                ("A", "3", None, 1, "b")], [("A", "3", "FALSE")]) == [("1", big - 1, "y"), ("2", None, None)]
    more = [("1", big - 1, "y"), ("2", None, None), ("4", 7, "c")]
    assert run([("A", "1", None, 0, "a"), ("A", "3", None, 0, "a"), ("A", "4", None, 7, "c")]) == more
    assert run([("A", "5", None, 1, "q")], [("A", "5", "TRUE")]) == more  # a result of the same batch counts first


def test_error_counts_are_compacted(spark, tmp_path):
    store_path, into = str(tmp_path / "a"), str(tmp_path / "b")
    assert jobs.stored_error_counts(spark, store_path).collect() == [] and jobs.stored_results(spark, store_path).collect() == []
    row = lambda n, b: ("T", "S", "update", "c", "E", "", "m", n, b)
    columns = jobs.COUNTS
    spark.createDataFrame([row(1, 0), row(5, 1)], columns).write.partitionBy("batch").parquet(store_path)
    jobs.compact_error_counts(spark, store_path, into)
    assert [r.row_count for r in jobs.stored_error_counts(spark, into).collect()] == [5]
    spark.createDataFrame([row(9, 2)], columns).write.mode("append").partitionBy("batch").parquet(into)
    assert [r.row_count for r in jobs.stored_error_counts(spark, into).collect()] == [9]


def test_rings_end_the_doubling_at_once(spark, monkeypatch):
    """Ten thousand rings of two, each with a chain of three behind it, and a chain of 40 that ends: the rounds of the chain, not of all nodes."""
    rounds, real = [], graph.skew_join
    monkeypatch.setattr(graph, "skew_join", lambda *a, **k: (rounds.append(1), real(*a, **k))[1])
    ring = spark.range(50_000).selectExpr("id as node", "case when id % 5 = 0 then id + 1 else id - 1 end as needs")
    chain = spark.range(100_001, 100_040).selectExpr("id as node", "id - 1 as needs")
    single = ring.unionByName(chain).selectExpr("node", "needs", "1L as w", "0L as base")
    got = {r.node: (r.stop, r.w) for r in graph._jumped(single).collect()}
    assert got == {i: (100_000, i - 100_000) for i in range(100_001, 100_040)}
    assert len(rounds) <= 9


def test_waves_of_records_without_an_id_and_given_twice(spark):
    n = spark.createDataFrame([("A", "1"), ("A", "1"), ("A", None), ("B", "1"), (None, "1")], "object string, record_id string")
    e = spark.createDataFrame([("B", "1", "A", None), ("A", None, "A", "1"), ("A", "1", "Z", "9"), ("Z", "9", "A", "1"), ("A", "1", "A", "1"), (None, "1", "B", "1")],
                              "object string, record_id string, needs_object string, needs_id string")
    got = sorted(map(tuple, graph.load_waves(n, e).collect()), key=str)
    assert got == sorted([("A", "1", 0, False), ("A", None, 1, False), ("B", "1", 2, False), (None, "1", 3, False)], key=str)


def test_the_rest_of_a_plan_is_read_in_few_passes(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i // 2, f"{i}") for i in range(600)] + [(None, "a"), (None, "b")], "id long, v string")
    base, written, real = str(tmp_path), [], type(df.write).parquet
    paged.plan_pages(df, "id", 5, f"{base}/plan", pages_a_step=1)
    monkeypatch.setattr(type(df.write), "parquet", lambda self, path, *a, **k: (written.append(path), real(self, path, *a, **k))[1])
    assert not paged.read_paged(df, "id", f"{base}/plan", f"{base}/out", f"{base}/cp", steps=2)
    assert len(written) == 2
    assert paged.read_paged(df, "id", f"{base}/plan", f"{base}/out", f"{base}/cp")
    assert len(written) <= 2 + 1 + paged.BATCHES
    got = paged.paged_rows(spark, f"{base}/out", df.schema)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    # Pages are the ranges of the plan, and rows without an id a page of their own.
    cut = spark.read.parquet(f"{base}/plan").filter("page >= 0")
    spans = [(r.page, r.low, r.high) for r in cut.collect()]
    for r in spark.read.parquet(f"{base}/out").collect():
        assert [r.page] == ([-1] if r.id is None else [p for p, low, high in spans if (low is None or r.id > low) and (high is None or r.id <= high)])


def test_the_time_of_a_literal_follows_its_length(spark):
    import time
    text = "[" + ", ".join(f"{{'k': 'it\\'s {i}', \"n\": None}}" for i in range(2000)) + "]"
    df = spark.createDataFrame([(text,)], "t string").repartition(1)
    began = time.time()
    told = df.select(literal_json(F.col("t"))).first()[0]
    assert json.loads(told) == ast.literal_eval(text)
    assert time.time() - began < 20


def test_doubling_leaves_one_table_whatever_its_rounds(spark):
    chain = lambda n: spark.range(1, n).selectExpr("id as node", "id - 1 as needs", "1L as w", "0L as base")
    parts = lambda df: df.rdd.getNumPartitions()
    short, long = graph._jumped(chain(3)), graph._jumped(chain(600))
    assert parts(long) <= parts(short)
    assert {r.node: (r.stop, r.w) for r in long.collect()} == {i: (0, i) for i in range(1, 600)}


def test_doubling_ends_with_a_ring_beside_a_long_chain(spark):
    rows = [(i, i - 1) for i in range(1, 300)] + [(1000 + i, 1000 + (i + 1) % 7) for i in range(7)] + [(2000, 1003), (2001, 2000)]
    single = spark.createDataFrame(rows, "node long, needs long").selectExpr("*", "1L as w", "0L as base")
    assert {r.node: (r.stop, r.w) for r in graph._jumped(single).collect()} == {i: (0, i) for i in range(1, 300)}
