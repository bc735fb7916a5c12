"""Extraction, configuration tables, text and value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions import failures, markup, payload, text, values
from twinledger.model import catalog, rows
from twinledger.operators.exclude import hard_excluded
from twinledger.operators.ranking import step_sample
from twinledger.operators.schema_diff import is_safe_field, is_writable, shared_fields
from twinledger.session import work_folder
from twinledger.sources import extract as ex, scope as sc, store

from .fixtures import MONEY, long_side, long_sql, read, wide, wide_sql
from .registry import query


@query(long_sql("new", ("Orders", "Customer")))
def long_extract(spark, sf):
    return long_side(spark, sf, "new", ("Orders", "Customer"))


@query("select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey limit 5000")
def row_cap(spark, sf):
    return ex.row_cap(read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", 5000)


@query("select o_orderkey, o_orderstatus from orders where o_orderkey > 700 order by o_orderkey limit 300")
def keyset_page(spark, sf):
    return ex.next_page(read(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 300, after=700)


@query("""select * from (select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderkey) r
          from orders) where r <= 3) order by o_custkey, o_orderkey limit 400""")
def step_sample_rows(spark, sf):
    return step_sample(read(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 3, 400)


PART_SCOPE = {
    "old_object": "concat(' ', p_brand, ' ')", "old_field": "case when p_size = 7 then 'N/A' else p_type end",
    "new_object": "case when p_size = 9 then '' else upper(p_brand) end", "new_field": "concat(p_name, ' f')",
    "ignore": "case when p_size % 5 = 0 then ' Yes' when p_size % 5 = 1 then 'no' end",
}


def part_scope(spark, sf):
    return read(spark, sf, "part").selectExpr(*[f"{e} as {n}" for n, e in PART_SCOPE.items()], "p_partkey as row_no")


@query("""select trim(p_brand) as object, case when p_size = 7 then 'N/A' else p_type end as field, min(p_partkey) as row_no
          from part where p_size % 5 <> 0 group by 1, 2""")
def scope_fields(spark, sf):
    return sc.scope_fields(part_scope(spark, sf), "old")


@query("""select distinct upper(p_brand) as object, concat(p_name, ' f') as field
          from part where p_size % 5 <> 0 and p_size <> 7 and p_size <> 9""")
def scope_pairs(spark, sf):
    return sc.scope_pairs(part_scope(spark, sf), "new", both_sides=True)


@query("""select s_name as object, cast(case when s_suppkey % 5 = 0 then 5 + s_suppkey else s_suppkey * 10 end as integer) as position
          from supplier where s_suppkey % 3 <> 0 and s_nationkey < 20 and s_nationkey <> 3""")
def sequence_filter(spark, sf):
    s = read(spark, sf, "supplier")
    sequence = s.selectExpr("s_name as object", "s_suppkey * 10 as load_order",
                            "case when s_suppkey % 3 = 0 then 'FALSE' else 'True' end as enabled",
                            "case when s_suppkey % 5 = 0 then cast(5 + s_suppkey as string) else '' end as manual_override_order")
    policy = s.selectExpr("s_name as object", "case when s_nationkey = 3 then 'OTHER' when s_nationkey = 4 then 'Prod' else '' end as required_source")
    only = s.where("s_nationkey < 20").selectExpr("s_name as object")
    return sc.in_sequence(sc.drop_foreign_sources(sc.enabled_objects(sequence, only), policy, "PROD"))


@query("""select 'Status' as field, 'read' as outcome, count(o_orderstatus) as n from orders
          union all select 'Owner.key', 'read', count(o_custkey) from orders
          union all select 'Nope', 'No such column ''Nope'' on entity ''Orders''.', 0
          union all select 'Account.Name', 'Didn''t understand relationship ''Account''.', 0
          union all select '', 'sObject type ''Lost'' is not supported.', 0""")
def schema_tolerant(spark, sf):
    o = read(spark, sf, "orders").selectExpr("o_orderkey as Id", "o_orderstatus as Status",
                                             "named_struct('key', o_custkey) as Owner")
    got = ex.extract(spark, "NEW", "new", {"Orders": o}, {"Orders": ["Status", "Nope", "Owner.key", "Account.Name", "Nope"], "Lost": ["X"]})
    good = got.long.groupBy("field").agg(F.count("value").alias("n")).select("field", F.lit("read").alias("outcome"), "n")
    return good.unionByName(got.errors.select("field", F.col("error").alias("outcome"), F.lit(0).cast("long").alias("n")))


@query("select obj, record_id, field, value, external_id from (" + long_sql("new", ("Orders", "Customer")) + ") where obj = 'Orders'")
def partition_roundtrip(spark, sf):
    path = work_folder(spark, "extract")
    store.write_extract(ex.with_bucket(long_side(spark, sf, "new", ("Orders", "Customer")), "new"), path)
    return store.read_extract(spark, path, objects=["Orders"]).select("obj", "record_id", "field", "value", "external_id")


BLANKS = """case o_orderkey % 12 when 0 then '' when 1 then '   ' when 2 then ' NULL ' when 3 then 'nan' when 4 then '<NA>'
 when 5 then 'N/A' when 6 then '#n/a' when 7 then ' None' when 8 then 'Yes ' when 9 then 't' when 10 then null else concat('  ', o_orderpriority, ' ') end"""


def _blank_sql(words):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"case when lower(trim(x)) in ({listed}) then null else trim(x) end"


@query(f"""select o_orderkey, {_blank_sql(text.BLANK_IN_KEYS)} as key_form, {_blank_sql(text.BLANK_IN_LOADS)} as load_form,
       {_blank_sql(text.BLANK_IN_METADATA)} as metadata_form, coalesce(lower(trim(x)) in ('true','t','yes','y','1'), false) as truthy,
       coalesce({_blank_sql(text.BLANK_IN_LOADS)} is null, true) as blank
       from (select o_orderkey, {BLANKS} as x from orders)""")
def blank_rules(spark, sf):
    x = F.col("x")
    return read(spark, sf, "orders").selectExpr("o_orderkey", f"{BLANKS} as x").select(
        "o_orderkey", text.key_text(x).alias("key_form"), text.load_text(x).alias("load_form"),
        text.metadata_text(x).alias("metadata_form"), text.truthy(x).alias("truthy"), text.is_blank(x).alias("blank"))


TYPED = ("case o_orderkey % 4 when 0 then 'boolean' when 1 then 'int' when 2 then 'currency' else 'string' end",
         "case when o_orderkey % 31 = 0 then ' none ' when o_orderkey % 4 = 0 then (case when o_orderkey % 8 = 0 then 'TRUE' else 'no' end) "
         f"when o_orderkey % 37 = 0 then 'abc' else concat(' ', {MONEY.format('o_totalprice')}) end",
         MONEY.format("o_totalprice"))


@query(f"""with t as (select o_orderkey, {TYPED[0]} as kind, {TYPED[1]} as x, {TYPED[2]} as y from orders),
      b as (select *, lower(trim(x)) = 'none' as blank, try_cast(trim(x) as double) as num from t)
      select o_orderkey,
        case when blank then null when kind = 'boolean' then case when lower(trim(x)) = 'true' then 'true' else 'false' end
             when kind = 'int' then cast(cast(trunc(num) as bigint) as varchar)
             when kind = 'currency' then case when num is not null then case when trim(x) like '%.00' then concat(cast(cast(num as bigint) as varchar), '.0')
                   else rtrim(cast(cast(num as decimal(18,2)) as varchar), '0') end end
             else x end as coerced,
        coalesce(kind in ('int', 'currency') and not blank and num is null, false) as bad_number,
        case when kind = 'boolean' then (not blank and lower(trim(x)) = 'true') is not distinct from false and not blank
             when kind in ('int', 'currency') then num is not distinct from try_cast(y as double)
             when blank then false else trim(x) = trim(y) end as same,
        case when blank then 'blank' when lower(trim(x)) in ('true', 'false') then concat('bool:', lower(trim(x))) else concat('text:', trim(x)) end as lookup_key
      from b""")
def typed_values(spark, sf):
    df = read(spark, sf, "orders").selectExpr("o_orderkey", f"{TYPED[0]} as kind", f"{TYPED[1]} as x", f"{TYPED[2]} as y")
    x, k = F.col("x"), F.col("kind")
    return df.select("o_orderkey", values.coerced(x, k).alias("coerced"), values.is_bad_number(x, k).alias("bad_number"),
                     values.equivalent(x, F.col("y"), k).alias("same"), values.lookup_key(x).alias("lookup_key"))


@query(r"""select doc_id, md5(t) as cell_md5, md5(case when length(t) > 2000 then concat(left(t, 2000), '...[truncated]') else t end) as short_md5
           from (select doc_id, replace(replace(replace(coalesce(text, ''), chr(13) || chr(10), '\n'), chr(13), '\n'), chr(10), '\n') as t from documents)""")
def csv_cells(spark, sf):
    d = store.fixed_columns(read(spark, sf, "documents"), ["doc_id", "text", "absent"])
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(store.cell(F.col("text"))).alias("cell_md5"),
                    F.md5(text.truncated(F.concat("text", F.coalesce("absent", F.lit(""))))).alias("short_md5"))


@query("""select event_id, json_extract_string(props, '$.k') as k, 'event_type; k; user' as merged_keys,
          json_extract_string(props, '$.k') as merged_k, 'k' as key_list, event_id % 9 = 0 as malformed from events""")
def payload_json(spark, sf):
    e = read(spark, sf, "events").select("event_id", "props", "event_type", "user_id", F.when(
        F.col("event_id") % 9 == 0, F.lit("[1]")).otherwise(F.col("props")).alias("maybe"))
    load = F.create_map(F.lit("k"), F.lit("under"), F.lit("event_type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    df = e.withColumn("p", payload.parse(F.col("props"))).withColumn("m", payload.merged(load, F.col("p")))
    stored = F.from_json(payload.to_text(F.col("m")), "map<string,string>")
    return df.select("event_id", F.col("p")["k"].alias("k"), F.array_join(F.map_keys(stored), "; ").alias("merged_keys"),
                     stored["k"].alias("merged_k"), payload.key_list(F.col("props")).alias("key_list"),
                     payload.is_malformed(F.col("maybe")).alias("malformed"))


# A field catalogue as large as the part table: one "field" per part.
PART_CATALOG = {
    "object": "p_brand", "field": "concat(p_name, ' ', cast(p_partkey as string))",
    "type": "case when p_size % 10 = 0 then 'reference' else p_type end", "label": "p_name",
    "createable": "p_size % 3 <> 0", "updateable": "p_size % 4 <> 0", "calculated": "p_size % 11 = 0",
}


def part_catalog(spark, sf):
    return catalog(read(spark, sf, "part").selectExpr(*[f"{e} as {n}" for n, e in PART_CATALOG.items()]))


@query("""select p_brand as object, concat(p_name, ' ', cast(p_partkey as varchar)) as field,
          case when p_size % 2 = 0 then p_size % 3 <> 0 else p_size % 4 <> 0 end as writable,
          p_size % 10 <> 0 and (p_size % 3 <> 0 or p_size % 4 <> 0) and p_size % 11 <> 0 as safe from part""")
def writable_fields(spark, sf):
    hint = F.when(F.col("even"), "create").otherwise("update")
    df = catalog(read(spark, sf, "part").selectExpr(*[f"{e} as {n}" for n, e in PART_CATALOG.items()])).join(
        read(spark, sf, "part").selectExpr("concat(p_name, ' ', cast(p_partkey as string)) as field", "p_size % 2 = 0 as even"), "field")
    return df.select("object", "field", is_writable(hint).alias("writable"), is_safe_field().alias("safe"))


@query("""select b.object, b.field, b.type, t.n as rows from (values
   ('Nation','n_nationkey','int'), ('Nation','n_name','string'), ('Nation','n_regionkey','reference'),
   ('Supplier','s_suppkey','int'), ('Supplier','s_name','string'), ('Supplier','s_nationkey','reference'), ('Supplier','s_acctbal','double')) b(object, field, type)
   join (select 'Nation' as object, count(*) as n from nation union all select 'Supplier', count(*) from supplier) t on t.object = b.object""")
def catalog_export(spark, sf):
    tables = {"Nation": read(spark, sf, "nation"), "Supplier": read(spark, sf, "supplier")}
    made = ex.catalog_from_tables(spark, tables, {("Nation", "n_regionkey"): ("Region", ["Region"]), ("Supplier", "s_nationkey"): ("Nation", ["Nation"])})
    sizes = None
    for n, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("object"), "rows")
        sizes = one if sizes is None else sizes.unionByName(one)
    return made.select("object", "field", "type").join(sizes, "object")


@query("""select p_brand as object, p_type as field from part where p_size % 2 = 0
          intersect select p_brand, p_type from part where p_size % 3 = 0""")
def set_ops(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_brand").alias("object"), F.col("p_type").alias("field"), "p_size")
    return shared_fields(p.where("p_size % 2 = 0"), p.where("p_size % 3 = 0"))


@query()
def join_bucket(spark, sf):
    o = wide(spark, sf, "Orders", "new")
    return o.select("Id", ex.join_bucket(F.coalesce("External_Id__c", F.lit(""))).alias("join_bucket"))


@query(r"""select doc_id, md5(trim(regexp_replace(nfc_normalize(text), '[\s\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g'))) as canonical_md5 from documents""")
def text_canonical(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.md5(text.canonical(F.col("text"))).alias("canonical_md5"))


def _repair_sql(c):
    out = f"nfc_normalize({c})"
    for bad, good in text.MOJIBAKE:
        out = f"replace({out}, '{bad}', '{good}')"
    return out


BROKEN = "concat(text, case doc_id % 4 when 0 then ' donâ€™t' when 1 then ' 10 â€“ 20' when 2 then ' Â x' else '' end)"


@query(f"select doc_id, md5({_repair_sql('t')}) as repaired_md5 from (select doc_id, {BROKEN} as t from documents)")
def text_repair(spark, sf):
    return read(spark, sf, "documents").selectExpr("doc_id", f"{BROKEN} as t").select("doc_id", F.md5(text.repaired(F.col("t"))).alias("repaired_md5"))


@query()
def markup_clean(spark, sf):
    return markup.with_clean_text(read(spark, sf, "pages"), "html", "clean").select(
        "page_id", F.md5("clean").alias("clean_md5"), F.length("clean").alias("clean_length"), (F.col("clean") != F.col("html")).alias("changed"))


@query(r"""select event_id, case when event_id % 3 = 0 then concat('No such column ''', event_type, ''' on entity ''Orders''.')
             when event_id % 3 = 1 then concat('Didn''t understand relationship ''', event_type, '''.') else concat(event_type, ' failed') end as short,
           case when event_id % 3 = 2 then null else event_type end as failed_field from events""")
def extract_errors(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("SELECT x\n No such column '"), "event_type", F.lit("' on entity 'Orders'. If you are"))).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit("  Didn't understand relationship '"), "event_type", F.lit("' in field path"))).otherwise(
        F.concat(F.lit("  "), "event_type", F.lit("\n failed ")))
    df = read(spark, sf, "events").select("event_id", failures.extract_error(raw).alias("short"))
    return df.select("event_id", "short", failures.failed_field(F.col("short"), F.array(F.lit("a"), F.lit("b.c"))).alias("failed_field"))
