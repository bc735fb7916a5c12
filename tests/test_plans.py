import pytest
from pyspark.sql import functions as F

from checks import loading as ld
from checks.fixtures import read, wide
from twinledger.model import rows
from twinledger.operators import parity, resolve
from twinledger.operators.rules import RULE_COLUMNS, apply_rules, default_rules
from twinledger.plans import execute, prepare
from twinledger.session import work_folder
from twinledger.sources import extract as ex, scope as sc, store

SF = "/root/testdata/sf0.001"
ENTRIES = "array<struct<name:string,ext_field:string,value:string>>"


def sale_long(df, env):
    """Target state as a long extract, to diff it again."""
    return df.filter("object = 'Sale'").select(F.lit(env).alias("env"), F.lit("Sale").alias("obj"), "record_id", F.explode("values").alias("field", "value"), "external_id")


def test_load_leaves_no_gap(spark):
    """Diff, prepare, load, diff again: mapped, writable fields agree and nothing is missing."""
    work = ld.prepared(spark, SF, ("Orders",)).work
    done = execute.run_load(work, ld.new_target(spark, SF), ld.field_catalog(spark), rows(spark, RULE_COLUMNS, [], ld.RULE_TYPES))
    old = wide(spark, SF, "Orders", "old").select(
        F.lit("OLD").alias("env"), F.lit("Sale").alias("obj"), F.col("Id").alias("record_id"),
        F.lit(None).cast("string").alias("external_id"), F.explode(F.create_map(
            F.lit("Stage"), F.expr("case Status when 'F' then 'Finished' when 'O' then 'Open' else Status end"))).alias("field", "value"))
    new = sale_long(done.target, "NEW").filter("field = 'Stage'").withColumn(
        "value", F.expr("case value when 'F' then 'Finished' when 'O' then 'Open' else value end"))
    left = parity.record_parity(new, old).paired.groupBy("change_type").count().collect()
    assert {r.change_type for r in left} <= {"missing_from_old"}
    assert done.results.filter("success <> 'TRUE'").isEmpty()


def test_prepare_twice_changes_nothing(spark):
    a, b = (ld.prepared(spark, SF).stored() for _ in range(2))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_children_find_parents_of_the_same_run(spark):
    cat = ld.field_catalog(spark)
    work = spark.sql(f"""select * from values
        ('Account', 'Customer', 'c1', cast(null as string), 'missing_from_new', 'upsert', cast(array(named_struct('name','Name','ext_field',cast(null as string),'value','n')) as {ENTRIES}), cast(array() as array<string>)),
        ('Sale', 'Orders', 's1', null, 'missing_from_new', 'upsert', array(named_struct('name','Buyer','ext_field','External_Id__c','value','c1')), array()),
        ('Sale', 'Orders', 's2', null, 'missing_from_new', 'upsert', array(named_struct('name','Buyer','ext_field','External_Id__c','value','nobody')), array())
        as t(target_object, source_object, source_record_id, target_record_id, change_type, operation, entries, skipped)""")
    target = spark.createDataFrame([], "object string, record_id string, external_id string, values map<string,string>")
    done = execute.run_load(work, target, cat, rows(spark, RULE_COLUMNS, [], ld.RULE_TYPES))
    got = {r.source_record_id: (r.operation, r.success, r.payload_json, r.message) for r in done.results.collect()}
    assert got["s1"][2] == '{"BuyerId":"Tc1"}'
    assert got["s2"][:2] == ("skip", "TRUE") and got["s2"][3] == execute.NOTHING_LEFT
    assert {r.record_id for r in done.target.collect()} == {"Tc1", "Ts1"}


def test_failures_of_apply(spark):
    ops = spark.sql(f"""select *, cast(null as string) as message from values
        ('A', 'S', '1', 'gone', 'data_gap', 'update', cast(array(named_struct('name','N','ext_field',cast(null as string),'value','v')) as {ENTRIES}), cast(array() as array<string>), 'ready'),
        ('A', 'S', '2', null, 'data_gap', 'create', array(named_struct('name','External_Id__c','ext_field',cast(null as string),'value','2')), array(), 'ready'),
        ('A', 'S', '3', 't3', 'data_gap', 'update', array(named_struct('name','N','ext_field',cast(null as string),'value',cast(null as string))), array(), 'ready')
        as t(target_object, source_object, source_record_id, target_record_id, change_type, operation, entries, skipped, status)""")
    target = spark.createDataFrame([("A", "t2", "2", {"N": "x"}), ("A", "t3", None, {"N": "y", "M": "z"})], "object string, record_id string, external_id string, values map<string,string>")
    done = execute.apply_operations(target, ops)
    got = {r.source_record_id: (r.success, r.message) for r in done.results.collect()}
    assert got["1"][0] == "FALSE" and "ENTITY_IS_DELETED" in got["1"][1]
    assert got["2"][0] == "FALSE" and "DUPLICATE_VALUE" in got["2"][1]
    assert {r.record_id: r["values"] for r in done.target.collect()} == {"t2": {"N": "x"}, "t3": {"N": None, "M": "z"}}
    dry = execute.apply_operations(target, ops, dry_run=True)
    assert {r.message for r in dry.results.collect()} == {execute.DRY_RUN} and dry.target is target


def test_shipped_rules(spark):
    cat = ld.field_catalog(spark, [("OpportunityLineItem", "TotalPrice", "currency", None, [], True, True, True, False), ("Subscriptions__c", "SL_Reason_for_Product_Change__c", "string", None, [], True, True, True, False)])
    df = spark.sql(f"""select * from values
        ('OpportunityLineItem', 'X', 'update', 'i1', cast(array(named_struct('name','UnitPrice','ext_field',cast(null as string),'value','1'), named_struct('name','TotalPrice','ext_field',null,'value','2'), named_struct('name','Product2','ext_field','External_Id__c','value','p')) as {ENTRIES}), cast(array() as array<string>)),
        ('OpportunityLineItem', 'X', 'create', null, array(named_struct('name','TotalPrice','ext_field',cast(null as string),'value','2')), array()),
        ('Subscriptions__c', 'X', 'upsert', null, array(named_struct('name','Q','ext_field',cast(null as string),'value','2')), array()),
        ('Account', 'Brand__c', 'create', null, array(named_struct('name','Q','ext_field',cast(null as string),'value','2')), array())
        as t(target_object, source_object, operation, target_record_id, entries, skipped)""")
    got = {(r.target_object, r.operation): ([e.name for e in r.entries], len(r.skipped)) for r in apply_rules(df, default_rules(spark), cat).collect()}
    assert got[("OpportunityLineItem", "update")] == (["UnitPrice"], 2)
    assert got[("OpportunityLineItem", "create")] == (["TotalPrice"], 0)
    assert got[("Subscriptions__c", "upsert")] == (["Q", "SL_Reason_for_Product_Change__c"], 1)
    assert got[("Account", "create")] == (["Q"], 1)


def test_batches_are_full_for_a_large_group(spark):
    ops = spark.range(1203).selectExpr("'A' as target_object", "'create' as operation", "lpad(cast(id as string), 6, '0') as source_record_id", "'ready' as status")
    sizes = sorted(r["count"] for r in execute.batched(ops, 500).groupBy("batch_no").count().collect())
    assert sizes == [203, 500, 500]
    with pytest.raises(ValueError):
        execute.batched(ops, 0)


def test_resume_refuses_other_settings(spark, table):
    path = work_folder(spark, "resume")
    columns = "env obj record_id field value external_id"
    new = ex.with_bucket(table(columns, [("N", "O", "N1", "f", "x", "1")]), "new")
    old = ex.with_bucket(table(columns, [("O", "O", "1", "f", "y", None)]), "old")
    assert store.done_buckets(spark, path, "a") is None
    store.write_paired(parity.record_parity(new, old).paired, new.unionByName(old), path, "a")
    done = store.done_buckets(spark, path, "a")
    assert store.skip_done(new, done).isEmpty()
    with pytest.raises(ValueError):
        store.done_buckets(spark, path, "b")
    assert parity.fields(store.read_paired(spark, path)).count() == 1


def test_config_readers(spark, tmp_path):
    f = tmp_path / "scope.csv"
    f.write_text("﻿SF 1.0 Object,SF 1.0 Field,SF 2.0 Object,SF 2.0 Field,Ignore\nA,x,B,y,\nA,z,B,w,TRUE\nA,n/a,B,q,\n", encoding="utf-8")
    scope = sc.read_scope(spark, str(f))
    assert [(r.source_field, r.target_field) for r in sc.field_mappings(scope).collect()] == [("x", "y")]
    assert sc.field_mappings(scope, honour_ignore=False).count() == 2
    with pytest.raises(ValueError):
        sc.read_policy(spark, str(f))
    g = tmp_path / "fields.csv"
    g.write_text("FIELD\nName\n\n Name \nId\n")
    assert [r.field for r in sc.read_field_names(spark, str(g)).orderBy("row_no").collect()] == ["Name", "Id"]


def test_csv_sink_is_one_line_per_row(spark, table, tmp_path):
    store.write_csv(table("a b", [("x\r\ny", None), ('q"q', "z")]).coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert sorted(text.splitlines()) == sorted(['"a","b"', '"x\\ny",""', '"q""q","z"'])


def test_row_numbers_for_tables_without_ids(spark):
    df = spark.createDataFrame([("b",), ("a",)], "x string")
    assert sorted((r.x, r.Id) for r in ex.wide_records(df).collect()) == [("a", "ROW_0"), ("b", "ROW_1")]
    assert read(spark, SF, "nation").count() == 25
    assert prepare.prepared_summary(ld.prepared(spark, SF).work).count() == 2


def test_bucket_text_survives_the_store(spark, table, tmp_path):
    rows = [("NEW", "024", f"R{i}", "f", str(i), f"x{i}", b) for i, b in enumerate(["000", "001", "024"])]
    df = table("env obj record_id field value external_id join_bucket", rows)
    for _ in range(2):  # a repeated write replaces itself
        store.write_extract(df, str(tmp_path / "x"))
    back = store.read_extract(spark, str(tmp_path / "x"))
    assert {r.join_bucket for r in back.collect()} == {"000", "001", "024"} and back.count() == 3
    assert store.read_extract(spark, str(tmp_path / "x"), objects=["024"], buckets=["024"]).count() == 1


def test_rerun_replaces_every_bucket_it_processed(spark, table, tmp_path):
    path, long = str(tmp_path / "diff"), "env obj record_id external_id field value"

    def sides(changed):
        new = table(long, [("N", o, f"N{o}", "1", "f", "x") for o in "AB"])
        old = table(long, [("O", o, "1", None, "f", "y" if o in changed else "x") for o in "AB"])
        return ex.with_bucket(new, "new"), ex.with_bucket(old, "old")

    def run(changed, config="a"):
        new, old = sides(changed)
        store.write_paired(parity.record_parity(new, old).paired, new.unionByName(old), path, config)
        return {r.obj for r in store.read_paired(spark, path).collect()}
    assert run("AB") == {"A", "B"}
    assert run("A") == {"A"}
    done = store.done_buckets(spark, path, "a")
    assert {r.obj: (r.record_rows, r.field_rows) for r in done.collect()} == {"A": (1, 1), "B": (0, 0)}
    assert store.done_buckets(spark, path, "b", resume=False) is None and store.done_buckets(spark, path, "b") is None
    assert run("B", "b") == {"B"} and store.done_buckets(spark, path, "b").count() == 2
    recs = str(tmp_path / "records")
    for changed in ("AB", "A"):
        store.write_record_parts(parity.record_parity(*sides(changed)).records, recs)
    assert {r.obj for r in store.read_record_parts(spark, recs).collect()} == {"A"}


LOAD_CATALOG = [("Opportunity", "Name", "string", None, [], True, True, True, False), ("Opportunity", "External_Id__c", "string", None, [], True, True, True, True),
                ("Opportunity", "ContactId", "reference", "Contact", ["Contact"], True, True, True, False),
                ("Contact", "Name", "string", None, [], True, True, True, False), ("Contact", "External_Id__c", "string", None, [], True, True, True, True),
                ("OpportunityContactRole", "OpportunityId", "reference", "Opportunity", ["Opportunity"], True, False, True, False),
                ("OpportunityContactRole", "ContactId", "reference", "Contact", ["Contact"], True, False, True, False),
                ("OpportunityContactRole", "IsPrimary", "boolean", None, [], True, True, True, False),
                ("OpportunityContactRole", "Role", "string", None, [], True, True, True, False)]


def test_load_routes_contacts_into_links(spark):
    entry = lambda n, v, e=None: {"name": n, "ext_field": e, "value": v}
    work = spark.createDataFrame([
        ("Contact", "Contact", "k1", None, "missing_from_new", "upsert", [entry("Name", "n")], []),
        ("Opportunity", "Deal", "o1", None, "missing_from_new", "upsert", [entry("Name", "x"), entry("Contact", "k1", "External_Id__c")], []),
        ("Opportunity", "Deal", "o2", None, "missing_from_new", "upsert", [entry("Name", "y"), entry("Contact", "k404", "External_Id__c")], []),
        ("Opportunity", "Deal", "o3", "T3", "data_gap", "update", [entry("Contact", "k9", "External_Id__c")], []),
        ("OpportunityContactRole", "Role", "r1", None, "missing_from_new", "create",
         [entry("Role", "buyer"), entry("Opportunity", "o3", "External_Id__c"), entry("Contact", "k1", "External_Id__c")], []),
    ], "target_object string, source_object string, source_record_id string, target_record_id string, change_type string, operation string, "
       f"entries {ENTRIES}, skipped array<string>")
    target = spark.createDataFrame([("Contact", "K9", "k9", {"Name": "c"}), ("Opportunity", "T3", "o3", {"Name": "z"}),
                                    ("OpportunityContactRole", "L1", None, {"OpportunityId": "T3", "ContactId": "K9", "IsPrimary": "false"})],
                                   "object string, record_id string, external_id string, values map<string,string>")
    cat = ld.field_catalog(spark, LOAD_CATALOG)
    done = execute.run_load(work, target, cat, default_rules(spark))
    links = {r.record_id: r["values"] for r in done.target.filter("object = 'OpportunityContactRole'").collect()}
    assert links["L1"]["IsPrimary"] == "true"
    made = {(v["OpportunityId"], v["ContactId"]): v for k, v in links.items() if k != "L1"}
    assert set(made) == {("To1", "Tk1"), ("T3", "Tk1")}
    assert made["To1", "Tk1"]["IsPrimary"] == "true" and made["T3", "Tk1"]["Role"] == "buyer"
    got = {(r.target_object, r.source_record_id): (r.operation, r.success) for r in done.results.collect()}
    assert got["OpportunityContactRole", "o2"] == ("skip", "FALSE") and got["OpportunityContactRole", "o3"] == ("update", "TRUE")
    assert got["Opportunity", "o1"] == ("upsert", "TRUE")
    # Processed records are not loaded again.
    again = execute.run_load(work, done.target, cat, default_rules(spark), results=done.results.filter("target_object <> 'Contact'"))
    assert {r.target_object for r in again.results.collect()} <= {"Contact", "OpportunityContactRole"}


def test_shipped_natural_keys(spark):
    keys = resolve.default_natural_keys(spark)
    target = spark.createDataFrame([("AccountContactRelation", "L2", None, {"AccountId": "A", "ContactId": "C"}), ("AccountContactRelation", "L1", None, {"AccountId": "A", "ContactId": "C"}),
                                    ("Account_Relationship__c", "M", None, {"Main_Account__c": "A", "Secondary_Account__c": "B", "Secondary_Party_Type__c": "p"}),
                                    ("Account", "X", "x", {"AccountId": "A", "ContactId": "C"})],
                                   "object string, record_id string, external_id string, values map<string,string>")
    links = resolve.known_links(target, keys)
    assert links.count() == 3
    entry = lambda **kv: [{"name": k, "ext_field": None, "value": v} for k, v in kv.items()]
    df = spark.createDataFrame([("AccountContactRelation", entry(AccountId="A", ContactId="C")), ("Account_Relationship__c", entry(Main_Account__c="A", Secondary_Account__c="B")),
                                ("Account_Relationship__c", entry(Main_Account__c="A", Secondary_Account__c="B", Secondary_Party_Type__c="q")), ("Account", entry(AccountId="A"))],
                               f"target_object string, entries {ENTRIES}")
    got = [(r.target_object, r.natural_id) for r in resolve.natural_key_match(df, links, keys).collect()]
    assert sorted(got, key=str) == sorted([("AccountContactRelation", "L1"), ("Account_Relationship__c", "M"), ("Account_Relationship__c", None), ("Account", None)], key=str)


def test_rows_without_a_key_are_spread_over_a_held_target(spark):
    """The buckets of a held target are not split at run time, so rows that ask it for nothing must not meet in one of them."""
    target = spark.range(200).selectExpr("'A' as object", "concat('R', id) as record_id", "concat('E', id) as external_id", "map('N', 'old') as values")
    ops = spark.range(4000).selectExpr(
        "'A' as target_object", "'S' as source_object", "cast(id as string) as source_record_id", "if(id % 100 = 0, concat('R', id div 100), null) as target_record_id",
        "'missing_from_new' as change_type", "if(id % 100 = 0, 'update', 'create') as operation",
        f"cast(array(named_struct('name','N','ext_field',cast(null as string),'value','v')) as {ENTRIES}) as entries", "cast(array() as array<string>) as skipped",
        "'ready' as status", "cast(null as string) as message")
    held, old = execute.held_target(target), {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for df in (execute.outcomes(ops, held), execute.actual_deltas(ops, held.rows, ld.field_catalog(spark), F.col("operation") == "update"),
                   resolve.resolve_ids(ops, held.keys, F.col("target_object"), F.col("target_record_id"), "_id", distinct=False)):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4000 and max(sizes) < 2000
        got = execute.outcomes(ops, held)
        assert got.filter("operation = 'update' and success and landed_id = target_record_id").count() == 40
        assert got.filter("operation = 'create' and success and landed_id = concat('T', source_record_id)").count() == 3960
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_code_of_prepared_work_is_compiled(spark):
    """The JVM compiles methods of up to 8,000 bytes; Spark gives up on code it cannot build (-1)."""
    import re
    held = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = ld.prepared(spark, SF).work._jdf.queryExecution().executedPlan()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    assert sizes and min(sizes) >= 0 and max(sizes) <= 8000
