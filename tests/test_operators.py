import random
from collections import deque

import pytest
from pyspark.sql import Window, functions as F

from twinledger.model import catalog, env_names, rows
from twinledger.operators import errors, graph, parity, ranking, resolve, schema_diff, skew, wide
from twinledger.operators.skew import key_hash
from twinledger.streaming import jobs

LONG = "env obj record_id field value external_id"


def reference_parity(new, old):
    """Dictionary form of the comparison, the expected result."""
    def load(rows_, key):
        out = {}
        for r in sorted(rows_, key=lambda r: (r[2], r[4] is not None, r[4] or "")):
            k = r[5] if key == "ext" else r[2]
            if k is not None:
                out.setdefault((r[1], k), {})[r[3]] = r[4]
        return out
    n, o = load(new, "ext"), load(old, "rec")
    norm = lambda v: None if v is None else " ".join(v.split())
    got = set()
    for k in set(n) | set(o):
        a, b = n.get(k), o.get(k)
        if a is None or b is None:
            kind = "missing_from_old" if b is None else "missing_from_new"
            for f, v in (a or b).items():
                if v is not None:
                    got.add((*k, f, kind))
        else:
            got |= {(*k, f, "data_gap") for f in set(a) | set(b) if norm(a.get(f)) != norm(b.get(f))}
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_parity_against_dictionaries(spark, table, seed):
    rnd = random.Random(seed)
    value = lambda: rnd.choice([None, "", "a", "b", " a ", "A", "null"])
    new = [("NEW", "O", f"N{i}", f"f{rnd.randrange(4)}", value(), rnd.choice([None, f"{i}", f"{i}", "7"])) for i in range(12) for _ in range(4)]
    old = [("OLD", "O", f"{i}", f"f{rnd.randrange(4)}", value(), None) for i in range(4, 16) for _ in range(4)]
    n, o = table(LONG, new), table(LONG, old)
    shown = lambda p: {(r.obj, r.new_record_id if False else r.external_id or r.old_record_id, r.field, r.change_type) for r in p.fields.collect()}
    plain = parity.record_parity(n, o)
    assert shown(plain) == reference_parity(new, old)
    hot = [spark.range(1).select(key_hash([F.lit("O"), F.lit("7")])).first()[0]]
    assert shown(parity.record_parity(n, o, hot=hot)) == shown(plain)


def test_parity_of_a_side_with_itself_is_empty_and_mirrors(spark, table):
    a = table(LONG, [("N", "O", "1", "f", "x", "1"), ("N", "O", "2", "f", "y", "2")])
    b = table(LONG, [("N", "O", "1", "f", "z", "1"), ("N", "O", "3", "f", None, "3")])
    assert parity.record_parity(a, a).paired.isEmpty()
    kinds = lambda p: sorted((r.key, r.change_type) for r in p.paired.select("key", "change_type").collect())
    assert kinds(parity.record_parity(a, b)) == [("1", "data_gap"), ("2", "missing_from_old"), ("3", "missing_from_new")]
    assert kinds(parity.record_parity(b, a)) == [("1", "data_gap"), ("2", "missing_from_new"), ("3", "missing_from_old")]


def test_existence_and_exclusions(spark, table):
    new = table(LONG, [("N", "O", "N1", "Id", "a", "1"), ("N", "O", "N2", "Name", "b", "2"), ("N", "Gone", "N3", "Name", "b", "3")])
    old = table(LONG, [("O", "O", "1", "Id", "z", None), ("O", "O", "2", "Name", "b", None), ("O", "O", "2", "Note", None, None)])
    p = parity.record_parity(new, old, exclusions=rows(spark, ["obj", "field", "reason"], [("Gone", None, "r")]), comparison_excluded=["*Id"])
    # Record 1 exists on both sides with excluded fields only; null equals absent; Gone vanished.
    assert p.paired.isEmpty()
    assert {(r.obj, r.field, r.excluded_row_count) for r in p.excluded.collect()} == {("O", "Id", 1), ("Gone", "Name", 1)} | {("O", "Id", 1)}
    only_new = parity.record_parity(new, old.filter("record_id = '2'"), comparison_excluded=["*Id"])
    r = only_new.records.filter("obj = 'O'").first()
    assert (r.change_type, r.new_value, r.new_load_value) == ("missing_from_old", {}, {"Id": "a"})


def test_markup_cleaning_applies_to_both_sides(spark, table):
    new = table(LONG, [("N", "O", "N1", "Body", "<p>hello</p>", "1")])
    old = table(LONG, [("O", "O", "1", "Body", "hello", None)])
    assert parity.record_parity(new, old, clean_markup=True).paired.isEmpty()
    p = parity.record_parity(new, old)
    assert p.paired.count() == 1
    assert [(r.field, r.cleaned_value_sample) for r in p.cleaned.collect()] == [("Body", "hello")]


def test_environment_names(spark, table):
    p = parity.record_parity(table(LONG, [("N", "O", "N1", "f", "x", "1")]), table(LONG, []))
    out = env_names(p.fields, "UAT", "Prod")
    assert out.columns == ["Obj", "Field", "uat_recordid", "prod_recordid", "External_Id__c", "UAT_value", "Prod_value", "change_type"]
    assert out.first().change_type == "missing_from_prod"


@pytest.mark.parametrize("group", [[], ["g"]])
def test_numbering_equals_window(spark, group):
    df = spark.range(500).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 7 as string) end as g", "cast(hash(id) % 50 as int) as o")
    by = Window.partitionBy(*group, F.lit(0)).orderBy("o", "id")
    want = df.withColumn("rank", F.row_number().over(by).cast("long"))
    for upto in (None, 1000, 2000):
        got = ranking.number_rows(df, group, ["o", "id"], upto=upto)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    left = spark.range(200).selectExpr("id", "case when id % 2 = 0 then 'hot' when id % 5 = 0 then null else cast(id as string) end as k")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("3", 3), ("999", 4)], "k string, v int")
    want = left.join(right, "k", how)
    got = skew.skew_join(left, right, ["k"], how).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError):
        skew.skew_join(left, right, ["k"], "full")


def test_hot_keys_are_found(spark, monkeypatch):
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as k")
    want = spark.range(1).select(key_hash([F.lit("hot")])).first()[0]
    assert skew.hot_keys(df, ["k"]) == []
    monkeypatch.setattr(skew, "TASK_BYTES", 0)
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    assert skew.hot_keys(df, ["k"]) == [want]


def test_text_rules_of_keys_are_worked_out_only_where_a_raw_bin_is_full(spark, monkeypatch):
    raw = spark.range(3000).selectExpr("cast(id as string) as k")
    df = raw.selectExpr("cast(raise_error('worked out') as string) as k")
    monkeypatch.setattr(skew, "TASK_BYTES", 0)
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    assert skew.hot_keys(df, ["k"], raw) == []
    hot = spark.range(3000).selectExpr("case when id % 3 = 0 then ' hot' else cast(id as string) end as k")
    want = spark.range(1).select(key_hash([F.lit("hot")])).first()[0]
    assert skew.hot_keys(hot.selectExpr("trim(k) as k"), ["k"], hot) == [want]


def test_the_diff_sorts_by_key_ahead_of_object(spark):
    side = spark.createDataFrame([("N", "A", "1", "f", "x", "1"), ("N", "A", "2", "f", "y", "2"), ("N", "B", "1", "f", "x", "1")],
                                 "env string, obj string, record_id string, field string, value string, external_id string")
    paired = parity.record_parity(side, side.withColumn("value", F.lit("x")), hot=[]).paired
    assert [(r.obj, r.new_record_id, r.change_type) for r in paired.collect()] == [("A", "2", "data_gap")]
    plan = paired._jdf.queryExecution().executedPlan().toString()
    assert "Sort [key#" in plan and "Sort [obj#" not in plan


def test_keys_are_not_sketched_where_no_bin_is_full(spark, monkeypatch):
    df = spark.range(3000).selectExpr("cast(id as string) as k")
    monkeypatch.setattr(skew, "TASK_BYTES", 0)
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    monkeypatch.setattr(skew, "FOUND", 0)  # a sketch of this size is refused
    assert skew.hot_keys(df, ["k"]) == []


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 2, {"x": "1"}), ("a", 1, {"x": "2"}), ("b", 5, {})], "k string, o int, m map<string,string>")
    assert sorted((r.k, r.o) for r in ranking.first_wins(df, ["k"], ["o"]).collect()) == [("a", 1), ("b", 5)]
    assert sorted((r.k, r.o) for r in ranking.last_wins(df, ["k"], ["o"]).collect()) == [("a", 2), ("b", 5)]


def kahn(nodes, needs):
    degree = {n: len(needs.get(n, ())) for n in nodes}
    after = {}
    for n, ds in needs.items():
        for d in ds:
            after.setdefault(d, set()).add(n)
    queue, out = deque(sorted(n for n in nodes if not degree[n])), []
    while queue:
        n = queue.popleft()
        out.append(n)
        for m in sorted(after.get(n, ())):
            degree[m] -= 1
            if not degree[m]:
                queue.append(m)
    return out + sorted(set(nodes) - set(out)), set(nodes) - set(out)


@pytest.mark.parametrize("seed", [5, 6])
def test_load_order_is_a_first_in_first_out_order(spark, seed):
    rnd = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(12)]
    needs = {n: {rnd.choice(nodes) for _ in range(rnd.randrange(3))} - {n} for n in nodes}
    edges = [(n, "f", d, "scoped") for n, ds in needs.items() for d in ds] + [("n01", "f", "n01", "scoped"), ("n02", "f", "Outside", "external")]
    e = spark.createDataFrame(edges, "object string, field string, dependency_object string, dependency_scope string")
    got = graph.load_order(spark.createDataFrame([(n,) for n in nodes], "object string"), e).orderBy("load_order").collect()
    want, cyclic = kahn(nodes, needs)
    assert [r.object for r in got] == want
    assert {r.object for r in got if r.in_cycle} == cyclic
    assert [r.load_order for r in got] == [10 + 10 * i for i in range(12)]


def test_waves_and_closure(spark):
    e = spark.createDataFrame([("A", "1", "B", "1"), ("B", "1", "C", "1"), ("A", "2", "B", "9"), ("D", "1", "D", "2"), ("D", "2", "D", "1"), ("A", "3", "D", "1"), ("A", "4", "A", "4")],
                              "object string, record_id string, needs_object string, needs_id string")
    n = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", "3"), ("A", "4"), ("B", "1"), ("C", "1"), ("D", "1"), ("D", "2")], "object string, record_id string")
    got = {(r.object, r.record_id): r.wave for r in graph.load_waves(n, e).collect()}
    assert got == {("A", "1"): 2, ("A", "2"): 0, ("A", "3"): None, ("A", "4"): 0, ("B", "1"): 1, ("C", "1"): 0, ("D", "1"): None, ("D", "2"): None}
    start = n.filter("object = 'A' and record_id in ('1', '3')")
    assert {tuple(r) for r in graph.closure(start, e).collect()} == {("A", "1"), ("B", "1"), ("C", "1"), ("A", "3"), ("D", "1"), ("D", "2")}


def test_wide_compare_multiplies_duplicates_and_keeps_keyless_rows_apart(spark):
    left = spark.createDataFrame([("l1", "K", 1.0), ("l2", "k ", 2.0), ("l3", None, 3.0), ("l4", "only", None)], "Id string, uid string, v double")
    right = spark.createDataFrame([("r1", "k", 1.0), ("r2", None, 9.0)], "Id string, uid string, v double")
    got = {(r.uid, r.source_id, r.target_id, r.field, r.change_type) for r in wide.compare_wide(left, right, "uid").collect()}
    assert got == {("k", "l2", "r1", "v", "CHANGED"), (None, "l3", None, None, "SOURCE_ONLY"), ("only", "l4", None, None, "SOURCE_ONLY"), (None, None, "r2", None, "TARGET_ONLY")}


def test_reference_order(spark):
    cat = catalog(spark.createDataFrame([("O", "P__c", "reference", "P__r", ["X", "Y"], True), ("O", "Q__c", "reference", "Q__r", ["X"], False)],
                                        "object string, field string, type string, relationship_name string, reference_to array<string>, nillable boolean"))
    ids = spark.createDataFrame([("X", "1", "x1", 1), ("Y", "1", "y1", 0), ("Y", "2", "y2", 1), ("X", "3", "old", 1), ("X", "3", "run", 0)], "object string, ext_id string, target_id string, origin int")
    entry = lambda n, v: f"named_struct('name', '{n}', 'ext_field', 'External_Id__c', 'value', {v})"
    work = spark.sql(f"""select 'O' as target_object, s as source_record_id, array({entry('P__r', 'p')}, {entry('Q__r', 'q')}) as entries, cast(array() as array<string>) as skipped
        from values ('a', '1', '3'), ('b', '2', '9'), ('c', ' ', '') as t(s, p, q)""")
    got = {r.source_record_id: ([(e.name, e.value) for e in r.entries], r.skipped) for r in resolve.resolve_references(work, cat, ids).collect()}
    assert got["a"] == ([("P__c", "x1"), ("Q__c", "run")], [])
    assert got["b"] == ([("P__c", "y2")], ["Q__r.External_Id__c=9: related record not found in X"])
    assert got["c"] == ([("P__c", None)], ["Q__r.External_Id__c: blank required relationship"])


def test_schema_compare_needs_both_types(spark, table):
    left = table("name type", [("a", "x"), ("b", None), ("c", "x")])
    right = table("field_name source_type", [("a", "y"), ("b", "y"), ("d", "y")])
    got = {r.field: r.status for r in schema_diff.compare_schemas(left, right).collect()}
    assert got == {"a": "TYPE_MISMATCH", "b": "SAME", "c": "ONLY_IN_LEFT", "d": "ONLY_IN_RIGHT"}


def test_closure_of_a_long_chain(spark):
    n = 20
    e = spark.createDataFrame([("A", str(i), "A", str(i + 1)) for i in range(n)], "object string, record_id string, needs_object string, needs_id string")
    got = graph.closure(spark.createDataFrame([("A", "3")], "object string, record_id string"), e)
    assert {r.record_id for r in got.collect()} == {str(i) for i in range(3, n + 1)} and got.count() == n - 2


def test_numbering_after_joins_of_cut_lineage_makes_as_many_tasks_as_its_rows_need(spark, monkeypatch):
    from twinledger.operators import ranking
    from twinledger.session import checkpointed
    a = checkpointed(spark.range(300).selectExpr("id", "id % 7 as g"))
    for _ in range(2):  # the estimate multiplies, the rows stay
        a = checkpointed(a.join(checkpointed(a.selectExpr("id", "g as g2")), "id").selectExpr("id", "g"))
    parts, real = [], type(a).repartitionByRange
    monkeypatch.setattr(type(a), "repartitionByRange", lambda self, n, *c: parts.append(n) or real(self, min(n, 8), *c))
    out = ranking.number_rows(a, ["g"], ["id"], "n")
    assert {(r.g, r.id): r.n for r in out.collect()} == {(i % 7, i): i // 7 + 1 for i in range(300)}
    assert parts == [1]


def test_messages_are_parsed_by_all_tasks(spark, table):
    names = "target_object source_object source_record_id operation success message"
    rows = table(names, [("A", "S", str(i), "update", "FALSE", f"REQUIRED_FIELD_MISSING:Required fields are missing: [F{i % 3}]:F{i % 3} --") for i in range(200)]).coalesce(1)
    out = jobs.running_error_counts(rows)
    assert "RoundRobinPartitioning" in out._jdf.queryExecution().executedPlan().toString()
    assert sum(r["row_count"] for r in out.collect()) == 200
    told = errors.classified(errors.spread(rows)).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(told) > 1 and sum(r["count"] for r in told) == 200
