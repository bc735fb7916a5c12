"""Stores that are written, stopped and taken up again; many patterns; deep graphs; literals; whole loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions import literals, markup, payload, values
from twinledger.functions.payload import items_text
from twinledger.model import RECORD_KEY, rows
from twinledger.operators import errors, graph, parity, patterns, ranking
from twinledger.operators.rules import apply_rules, default_rules
from twinledger.plans import execute, prepare
from twinledger.session import work_folder
from twinledger.sources import extract as ex, paged, result_store, scope as sc, store

from .fixtures import long_side, long_sql, parity_sql, read, wide_sql
from .loading import RESOLVED_SQL, RULES, RULE_COLUMNS, RULE_TYPES, field_catalog, id_maps, new_target, prepared
from .parities import FIELD_SQL, PAIR, both
from .registry import SQL, query
from .walks import LINE, MESSAGES, PARSED_SQL, error_results


def bucket_sql(key: str) -> str:
    """CRC-32 of ASCII text, bit by bit, in SQL, and the bucket it gives."""
    zeros = ", ".join(["0::ubigint"] * 8)
    step = f"list_reduce(list_concat([xor(c, b)], [{zeros}]), lambda d, z: case when d % 2 = 1 then xor(d // 2, 3988292384::ubigint) else d // 2 end)"
    crc = f"xor(list_reduce(list_concat([4294967295::ubigint], list_transform(string_split({key}, ''), lambda x: ascii(x)::ubigint)), lambda c, b: {step}), 4294967295::ubigint)"
    return f"case when length(coalesce({key}, '')) > 0 then lpad(cast({crc} % 32 as varchar), 3, '0') else 'missing' end"


# --- diff store ------------------------------------------------------------------------------

FIELD_KEY = "coalesce(nullif(external_id, ''), old_record_id)"


def _sides(spark, sf):
    return (ex.with_bucket(long_side(spark, sf, s, PAIR), s) for s in ("new", "old"))


def _stored_twice(spark, sf):
    """All buckets without one field, then the first half of the buckets again with all fields."""
    path = work_folder(spark, "rerun")
    new, old = _sides(spark, sf)
    without = rows(spark, ["obj", "field", "reason"], [("Orders", "Priority", "later")])
    store.write_paired(parity.record_parity(new, old, without).paired, new.unionByName(old), path, "a")
    first = F.col("join_bucket") < "016"
    new, old = new.filter(first), old.filter(first)
    store.write_paired(parity.record_parity(new, old).paired, new.unionByName(old), path, "a")
    return path


RERUN_SQL = f"""select f.*, {bucket_sql(FIELD_KEY)} as bucket from ({parity_sql(PAIR)} {FIELD_SQL}) f where bucket < '016'
  union all select f.*, {bucket_sql(FIELD_KEY)} as bucket from ({parity_sql(PAIR, "not (obj = 'Orders' and field = 'Priority')", "not (obj = 'Orders' and field = 'Priority')")} {FIELD_SQL}) f where bucket >= '016'"""


@query(f"select * exclude (bucket) from ({RERUN_SQL})")
def diff_rerun(spark, sf):
    return parity.fields(store.read_paired(spark, _stored_twice(spark, sf)))


@query(f"select * exclude (bucket) from ({RERUN_SQL}) where obj = 'Orders' and bucket in ('003', '020')")
def bucket_reader(spark, sf):
    return parity.fields(store.read_paired(spark, _stored_twice(spark, sf), objects=["Orders"], buckets=["003", "020"]))


@query(parity_sql(PAIR) + "select obj, new_record_id, old_record_id, change_type, 8 as columns from status where change_type is not null")
def public_records(spark, sf):
    path = work_folder(spark, "public")
    store.write_public(both(spark, sf, comparison_excluded=["*NoSuch"]).records, path)
    back = spark.read.parquet(path)
    return back.select("obj", "new_record_id", "old_record_id", "change_type", F.lit(len(back.columns)).alias("columns"))


@query(r"select doc_id, md5(replace(replace(replace(coalesce(text, ''), chr(13) || chr(10), '\n'), chr(13), '\n'), chr(10), '\n')) as text_md5, coalesce(lang, '') as lang from documents")
def csv_roundtrip(spark, sf):
    path = work_folder(spark, "csv")
    store.write_csv(read(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    back = spark.read.csv(path, header=True, quote='"', escape='"', schema="doc_id long, text string, lang string")
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), F.coalesce("lang", F.lit("")).alias("lang"))


# Queries of other modules whose SQL needs the buckets.
SQL["join_bucket"] = f"select Id, {bucket_sql('External_Id__c')} as join_bucket from ({wide_sql('Orders', 'new')})"
SQL["audit_summary"] = parity_sql(PAIR) + f""", fd as ({FIELD_SQL}), r as (select * from status where change_type is not null),
   b as (select obj, {bucket_sql('k')} as bucket from (select obj, external_id as k from ({long_sql('new', PAIR)}) union all select obj, record_id from ({long_sql('old', PAIR)}))),
   rb as (select obj, {bucket_sql('key')} as bucket from r), fb as (select obj, {bucket_sql(FIELD_KEY)} as bucket from fd)
   select * from (values ('record_level_scan_completed', 'True'), ('field_level_scan_completed', 'True')) v(metric, value)
   union all select 'completed_bucket_count', cast(count(*) as varchar) from (select distinct obj, bucket from b)
   union all select 'record_part_count', cast(count(*) as varchar) from (select distinct obj, bucket from rb) union all select 'field_part_count', cast(count(*) as varchar) from (select distinct obj, bucket from fb)
   union all select 'manifest_record_diff_rows', cast(count(*) as varchar) from r union all select 'manifest_field_diff_rows', cast(count(*) as varchar) from fd
   union all select 'audited_record_diff_rows', cast(count(*) as varchar) from r
   union all select 'invalid_record_object_rows', cast(count(*) as varchar) from r where obj <> 'Orders'
   union all select 'audited_field_diff_rows', cast(count(*) as varchar) from fd
   union all select 'invalid_field_pair_rows', cast(count(*) as varchar) from fd where not (obj = 'Orders' and field in ('Status', 'Price'))
   union all select 'unique_field_change_groups', cast(count(*) as varchar) from (select distinct obj, field, change_type from fd)"""


# --- reading ----------------------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_orderstatus from orders")
def paged_read(spark, sf):
    """Stopped after one step, then taken up again."""
    base = work_folder(spark, "paged")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    paged.plan_pages(orders, "o_orderkey", 500, f"{base}/plan", pages_a_step=2)
    ended = paged.read_paged(orders, "o_orderkey", f"{base}/plan", f"{base}/out", f"{base}/cp", steps=1)
    if not ended:
        paged.read_paged(orders, "o_orderkey", f"{base}/plan", f"{base}/out", f"{base}/cp")
    return paged.paged_rows(spark, f"{base}/out", orders.schema)


@query("select concat('ROW_', cast(row_number() over (order by p_name, p_brand, p_size, p_type) - 1 as varchar)) as Id, p_name, p_brand, p_size, p_type from part")
def unnumbered_rows(spark, sf):
    return ex.wide_records(read(spark, sf, "part").select("p_name", "p_brand", "p_size", "p_type")).select("Id", "p_name", "p_brand", "p_size", "p_type")


@query("""with s as (select s_name as object, case when s_suppkey % 4 = 0 then null when s_suppkey % 5 = 0 then 5 + s_suppkey else s_suppkey * 10 end as position from supplier where s_suppkey % 3 <> 0)
   select object, cast(position as integer) as position, row_number() over (order by position nulls last, object) as place from s""")
def sequence_positions(spark, sf):
    """Written as the file that is read, and numbered in its order."""
    path = work_folder(spark, "sequence")
    read(spark, sf, "supplier").selectExpr(
        "case when s_suppkey % 4 = 0 then '' else cast(s_suppkey * 10 as string) end as Load_Order", "concat(' ', s_name) as Object",
        "case when s_suppkey % 3 = 0 then 'no' else 'TRUE ' end as Enabled",
        "case when s_suppkey % 4 <> 0 and s_suppkey % 5 = 0 then cast(5 + s_suppkey as string) else 'n/a' end as Manual_Override_Order").coalesce(1).write.csv(path, header=True)
    return sc.placed(sc.enabled_objects(sc.read_sequence(spark, path)))


@query("""select distinct lpad(cast(p_size as varchar), 15, '0') as source_recordtypeid, p_type as source_developername, lower(p_type) as target_developername from part where p_size % 2 = 0""")
def record_type_file(spark, sf):
    path = work_folder(spark, "types")
    p = read(spark, sf, "part").where("p_size % 2 = 0")
    p.selectExpr("'Item' as SobjectType", "p_type as Source_DeveloperName", "lpad(cast(p_size as string), 15, '0') as Source_RecordTypeId",
                 "lower(p_type) as Target_DeveloperName").distinct().coalesce(1).write.csv(path, header=True)
    return sc.read_record_types(spark, path).select("source_recordtypeid", "source_developername", "target_developername")


# --- values, text, payloads ---------------------------------------------------------------------

FLAGS = """case event_id % 10 when 0 then 'true' when 1 then 'false' when 2 then '" True "' when 3 then '"yes"' when 4 then '1' when 5 then '0' when 6 then 'null'
  when 7 then '{"a":1}' when 8 then '2.5' else '{}' end"""
FAILED = "event_id % 3 = 0"


@query(f"""select event_id, event_id % 10 in (0, 2) or (event_id % 10 in (4, 7, 8) and not {FAILED}) as from_variant, event_id % 10 in (0, 2) as from_text,
   event_id % 3 <> 0 as from_number, event_id % 2 = 0 as from_boolean from events""")
def outcome_flags(spark, sf):
    from pyspark.sql import types as T
    e = read(spark, sf, "events").selectExpr("event_id", f"parse_json({FLAGS}) as v", f"""case event_id % 10 when 0 then 'true' when 2 then ' TRUE ' when 6 then null else 'x' end as t""",
                                             "event_id % 3 as n", "event_id % 2 = 0 as b", f"case when {FAILED} then array('e') else cast(array() as array<string>) end as listed")
    return e.select("event_id", values.outcome(F.col("v"), T.VariantType(), F.col("listed")).alias("from_variant"), values.outcome(F.col("t")).alias("from_text"),
                    values.outcome(F.col("n"), T.LongType()).alias("from_number"), values.outcome(F.col("b"), T.BooleanType()).alias("from_boolean"))


MARKED = """case c_custkey % 4 when 0 then concat('<div><p style="x">', c_name, '</p> &amp; <b>', c_mktsegment, '</b></div>') when 1 then concat('one<br>two&nbsp;', c_name, chr(13), chr(10), 'three')
  when 2 then concat('a < b ', c_name) else null end"""
CLEAN = """case c_custkey % 4 when 0 then concat(c_name, chr(10), '& ', c_mktsegment) when 1 then concat('one', chr(10), 'two', chr(160), c_name, chr(10), 'three') when 2 then concat('a < b ', c_name) end"""


@query(f"select c_custkey, {CLEAN} as cleaned from customer")
def markup_text(spark, sf):
    return markup.with_clean_text(read(spark, sf, "customer").selectExpr("c_custkey", f"{MARKED} as t"), "t", "cleaned").select("c_custkey", "cleaned")


@query(f"""select 'NEW' as env, 'Customer' as obj, cast(c_custkey as varchar) as record_id, 'Text' as field, 'Removed HTML/CSS/Office markup from value' as reason,
   replace(replace({MARKED}, chr(13) || chr(10), '\\n'), chr(10), '\\n') as original_value_sample, replace({CLEAN}, chr(10), '\\n') as cleaned_value_sample from customer where c_custkey % 4 < 2""")
def cleaned_audit(spark, sf):
    long_df = read(spark, sf, "customer").selectExpr("'NEW' as env", "'Customer' as obj", "cast(c_custkey as string) as record_id", "'Text' as field", f"{MARKED} as value", "cast(null as string) as external_id")
    return parity.record_parity(long_df, long_df.limit(0), clean_markup=True).cleaned


@query("select event_id, case event_id % 4 when 0 then '[1]' when 1 then concat('{\"k\":', cast(event_id as varchar)) else 'x' end as payload_json, 'payload is no JSON object' as reason from events where event_id % 4 < 3")
def payload_quarantine(spark, sf):
    e = read(spark, sf, "events").selectExpr("event_id", "case event_id % 4 when 0 then '[1]' when 1 then concat('{\"k\":', cast(event_id as string)) when 2 then 'x' else props end as payload_json")
    good, bad = prepare.split_malformed(e, ["payload_json"])
    if good.filter(payload.is_malformed(F.col("payload_json"))).isEmpty():
        return bad.select("event_id", "payload_json", "reason")
    return bad.limit(0).select("event_id", "payload_json", "reason")


SAID = """case event_id % 5
 when 0 then concat('[{''message'': "it''s ', event_type, '", ''errorCode'': ''DUPLICATE_VALUE'', ''fields'': (''A'', "B "), ''n'': None}]')
 when 1 then concat('{''success'': False, ''errors'': [{''statusCode'': "REQUIRED_FIELD_MISSING", ''message'': ''say ', chr(92), '''x', chr(92), ''' ', cast(event_id as string), ''', ''fields'': ["X''s", ''Y'', ]}]}')
 when 2 then concat('Malformed. Response content: [{''message'': "a" ''b', chr(92), 'x41'', ''errorCode'': ''E', chr(92), 'u0042'', ''fields'': [], ''at'': -1_0.5e1}]')
 when 3 then '[{''message'': ''cut, ''errorCode'': ''X'', ''fields'': [''P'', "Q"]}]'
 else concat('{''duplicateResult'': {''errorMessage'': ''use "', event_type, '"''}, ''message'': ''m''}') end"""


@query("""select event_id, case event_id % 5 when 0 then 'DUPLICATE_VALUE' when 1 then 'REQUIRED_FIELD_MISSING' when 2 then 'EB' when 3 then 'X' else 'DUPLICATES_DETECTED' end as error_code,
   case event_id % 5 when 0 then 'A; B' when 1 then 'X''s; Y' when 2 then '' when 3 then 'P; Q' else '' end as error_fields,
   case event_id % 5 when 0 then concat('it''s ', event_type) when 1 then concat('say ''x'' ', cast(event_id as varchar)) when 2 then 'abA' when 3 then 'cut, ' else concat('use "', event_type, '"') end as error_message,
   event_id % 5 <> 3 and event_id % 5 <> 2 as whole from events""")
def error_literals(spark, sf):
    from twinledger.functions.failures import with_parsed_error
    e = read(spark, sf, "events").selectExpr("event_id", "event_type", f"{SAID} as message")
    return with_parsed_error(e).select("event_id", "error_code", "error_fields", "error_message", literals.literal_json(F.col("message")).isNotNull().alias("whole"))


# --- patterns -------------------------------------------------------------------------------------

NAMED = "concat(replace(p_name, ' ', ''), cast(p_partkey as string))"
SPEC = f"""case p_partkey % 6 when 0 then concat(p_brand, '.', left({NAMED}, 5), '*') when 1 then concat('*', right({NAMED}, 4)) when 2 then concat(left({NAMED}, 3), '?*', right({NAMED}, 2))
  when 3 then {NAMED} when 4 then concat(p_brand, '.*', substring({NAMED}, 4, 4), '*') else concat('[a-m]*', right({NAMED}, 3)) end"""
PLACE = "(p_partkey * 7919) % 100003"


@query(f"""with n as (select distinct p_brand as obj, {NAMED} as field from part), s as (select {PLACE} as place, {SPEC} as spec from part),
   t as (select *, case when contains(spec, '.') then split_part(spec, '.', 1) else '*' end as o, case when contains(spec, '.') then split_part(spec, '.', 2) else spec end as f from s)
   select obj, field, arg_min(spec, place) as spec from n join t on (o = '*' or o = obj) and field glob f group by 1, 2""")
def many_patterns(spark, sf):
    p = read(spark, sf, "part")
    return patterns.first_specs(p.selectExpr("p_brand as obj", f"{NAMED} as field"), p.selectExpr(f"{PLACE} as place", f"{SPEC} as spec"))


@query(parity_sql(PAIR, compared="not (field like '%Id' or field = 'Segment')") + FIELD_SQL)
def many_exclusions(spark, sf):
    """The comparison with a few hundred specs, of which two match."""
    return both(spark, sf, comparison_excluded=[*(f"Other{i}.Field{i}*" for i in range(300)), "*Id", "Customer.Segment", "Customer.Seg*"]).fields


# --- graphs, samples ------------------------------------------------------------------------------

RING = "(o_orderkey // 5000) % 3 = 2 and (o_orderkey // 5000 + 1) * 5000 <= (select count(*) from orders)"


@query(f"""with o as (select o_orderkey as k, o_orderkey % 5000 as wave, {RING} as ring from orders), p as (select p_partkey as k, p_partkey % 100 as wave from part)
   select 'Order' as object, cast(k as varchar) as record_id, case when not ring then cast(wave as integer) end as wave, ring as in_cycle from o
   union all select 'Part', cast(k as varchar), cast(wave as integer), false from p
   union all select 'Line', {LINE}, case when not bool_or(ring) then cast(max(greatest(o.wave, p.wave)) + 1 as integer) end, bool_or(ring) from lineitem join o on o.k = l_orderkey join p on p.k = l_partkey group by 1, 2""")
def deep_waves(spark, sf):
    """Orders in chains of 5,000, of which every third is closed to a ring, parts in chains of 100, lines behind both."""
    o, p, li = (read(spark, sf, t) for t in ("orders", "part", "lineitem"))
    end = o.count()
    edge = lambda df, where, obj, r, no, nr: df.where(where).selectExpr(f"'{obj}' as object", f"{r} as record_id", f"'{no}' as needs_object", f"cast({nr} as string) as needs_id")
    edges = (edge(o, "o_orderkey % 5000 <> 0", "Order", "cast(o_orderkey as string)", "Order", "o_orderkey - 1")
             .unionByName(edge(o, f"o_orderkey % 5000 = 0 and (o_orderkey div 5000) % 3 = 2 and o_orderkey + 5000 <= {end}", "Order", "cast(o_orderkey as string)", "Order", "o_orderkey + 4999"))
             .unionByName(edge(p, "p_partkey % 100 <> 0", "Part", "cast(p_partkey as string)", "Part", "p_partkey - 1"))
             .unionByName(edge(li, "true", "Line", LINE, "Order", "l_orderkey")).unionByName(edge(li, "true", "Line", LINE, "Part", "l_partkey")))
    nodes = (o.selectExpr("'Order' as object", "cast(o_orderkey as string) as record_id").unionByName(p.selectExpr("'Part' as object", "cast(p_partkey as string) as record_id"))
             .unionByName(li.selectExpr("'Line' as object", f"{LINE} as record_id")))
    return graph.load_waves(nodes, edges)


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, row_number() over (order by md5(concat_ws('|', '8451', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
   l_orderkey, l_linenumber, l_partkey, l_suppkey) as r from lineitem) where r <= 5000""")
def large_sample(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranking.seeded_sample(read(spark, sf, "lineitem").select(*key), [], key, 5000)


@query(f"""with g as (select count(*) as n, target_object, source_object, operation, error_category, error_code, error_fields,
     case event_id % 8 when 0 then 'duplicate value found: on record <SF_ID>' when 4 then 'Remote end closed connection URL now' else error_message end as m from ({PARSED_SQL}) group by 2, 3, 4, 5, 6, 7, 8)
   select row_number() over (order by n desc, target_object, error_code, m, source_object, operation, error_category, error_fields) as place, n as occurrence_count, target_object, error_code, m as normalized_error_message from g""")
def review_positions(spark, sf):
    out = errors.review_places(errors.group_failures(error_results(spark, sf), ["source_record_id"]))
    return out.select("place", "occurrence_count", "target_object", "error_code", "normalized_error_message")


# --- loads ---------------------------------------------------------------------------------------------

KEYED_SQL = RESOLVED_SQL + """, hit as (select source_record_id from rs where target_object = 'Account' and cast(source_record_id as bigint) % 9 = 0 group by 1
     having count(*) filter (name = 'Name') > 0 and count(*) filter (name = 'NationId') > 0),
   x as (select r.target_object, r.source_object, r.source_record_id, case when h.source_record_id is not null then concat('N', r.source_record_id) else r.target_record_id end as target_record_id, r.change_type,
     case when h.source_record_id is not null then 'update' else operation end as operation, fresh and h.source_record_id is null as fresh, h.source_record_id is not null as hit, name, value
     from rs r left join hit h on h.source_record_id = r.source_record_id and r.target_object = 'Account'),
   k as (select distinct target_object, source_object, source_record_id, target_record_id, change_type, operation, fresh, hit from x),
   y as (select * from x where name is not null and not (target_object = 'Sale' and name = 'Rounded') and not (target_object = 'Sale' and name = 'Stage' and operation = 'update')
     union all select *, 'Priority', '5-LOW' from k where target_object = 'Sale' and fresh and not exists (select 1 from x where x.target_object = k.target_object and x.source_record_id = k.source_record_id and name = 'Priority')
     union all select *, 'NationId', 'RT9' from k where target_object = 'Account' and fresh and not exists (select 1 from x where x.target_object = k.target_object and x.source_record_id = k.source_record_id and name = 'NationId')
     union all select *, 'External_Id__c', source_record_id from k where target_object = 'Account' and (hit or fresh)),
   z as (select * from y where not (hit and cast(source_record_id as bigint) % 11 <> 0 and (name = 'Name' or (name = 'Balance' and cast(source_record_id as bigint) % 23 <> 0)))),
   e as (select target_object, source_record_id, string_agg(concat(name, '=', coalesce(value, '<null>')), '|' order by concat(name, '=', coalesce(value, '<null>'))) as entries from z group by 1, 2)
   select k.target_object, k.source_object, k.source_record_id, k.target_record_id, k.change_type, case when e.entries is null then 'skip' else k.operation end as operation, coalesce(e.entries, '') as entries,
     case when e.entries is null then 'skipped' else 'ready' end as status, case when e.entries is null then 'No writable prepared payload after relationship resolution/rules' end as message
   from k left join e on e.target_object = k.target_object and e.source_record_id = k.source_record_id"""


@query(KEYED_SQL)
def plan_keyed(spark, sf):
    """Operations with the target's values, known links, natural keys, rules and record types."""
    links = read(spark, sf, "customer").where("c_custkey % 9 = 0").selectExpr(
        "'Account' as target_object", "c_name as k1", "concat('C', c_nationkey) as k2", "cast(null as string) as k3", "concat('N', c_custkey) as target_id")
    keys = rows(spark, ["target_object", "key_1", "key_2", "key_3"], [("Account", "Name", "NationId", None)], "target_object string, key_1 string, key_2 string, key_3 string")
    types = rows(spark, ["object", "developer_name", "id"], [("Account", "Main", "RT9")])
    out = execute.plan_operations(prepared(spark, sf).work, field_catalog(spark), id_maps(spark, sf), rows(spark, RULE_COLUMNS, RULES, RULE_TYPES),
                                  current=new_target(spark, sf), links=links, keys=keys, record_types=types)
    return out.select(*execute.WORK_COLUMNS, "operation", items_text(F.col("entries")).alias("entries"), "status", "message")


DEAL_CATALOG = [
    ("Opportunity", "Name", "string", None, [], True, True, True, False), ("Opportunity", "External_Id__c", "string", None, [], True, True, True, True),
    ("Opportunity", "ContactId", "reference", "Contact", ["Contact"], True, True, True, False),
    ("Contact", "Name", "string", None, [], True, True, True, False), ("Contact", "External_Id__c", "string", None, [], True, True, True, True),
    ("OpportunityContactRole", "OpportunityId", "reference", "Opportunity", ["Opportunity"], True, False, True, False),
    ("OpportunityContactRole", "ContactId", "reference", "Contact", ["Contact"], True, False, True, False),
    ("OpportunityContactRole", "IsPrimary", "boolean", None, [], True, True, True, False),
]
KNOWN = "({0} % 4 <> 0 and {0} % 7 <> 0)"


def _entry(name, value, ext="null"):
    return f"named_struct('name', '{name}', 'ext_field', cast({ext} as string), 'value', {value})"


def deals(spark, sf):
    """Work on contacts and opportunities, and on two objects that sequence and policy leave out; the target; what configures the load."""
    nothing, blank = "cast(array() as array<string>) as skipped", "cast(null as string)"
    c, o = read(spark, sf, "customer"), read(spark, sf, "orders")

    def made(df, obj, source, key, target, kind, operation, entries):
        return df.selectExpr(f"'{obj}' as target_object", f"'{source}' as source_object", f"cast({key} as string) as source_record_id", f"{target} as target_record_id", f"{kind} as change_type",
                             f"{operation} as operation", f"array({', '.join(entries)}) as entries", nothing)
    work = (made(c.where("c_custkey % 4 = 0"), "Contact", "Person", "c_custkey", blank, "'missing_from_new'", "'upsert'", [_entry("Name", "c_name")])
            .unionByName(made(o, "Opportunity", "Deal", "o_orderkey", f"case when o_orderkey % 5 = 0 then concat('P', o_orderkey) else {blank} end", "case when o_orderkey % 5 = 0 then 'data_gap' else 'missing_from_new' end",
                              "case when o_orderkey % 5 = 0 then 'update' else 'upsert' end", [_entry("Name", "o_orderstatus"), _entry("Contact", "cast(o_custkey as string)", "'External_Id__c'")]))
            .unionByName(made(read(spark, sf, "supplier"), "Lead", "Maker", "s_suppkey", blank, "'missing_from_new'", "'upsert'", [_entry("Name", "s_name")]))
            .unionByName(made(read(spark, sf, "nation"), "Asset", "Place", "n_nationkey", blank, "'missing_from_new'", "'upsert'", [_entry("Name", "n_name")])))
    target = (c.where(KNOWN.format("c_custkey")).selectExpr("'Contact' as object", "concat('K', c_custkey) as record_id", "cast(c_custkey as string) as external_id", "map('Name', 'old') as values")
              .unionByName(o.where("o_orderkey % 5 = 0").selectExpr("'Opportunity' as object", "concat('P', o_orderkey) as record_id", "cast(o_orderkey as string) as external_id", "map('Name', 'old') as values"))
              .unionByName(o.where(f"o_orderkey % 10 = 0 and {KNOWN.format('o_custkey')}").selectExpr(
                  "'OpportunityContactRole' as object", "concat('L', o_orderkey) as record_id", "cast(null as string) as external_id",
                  "map('OpportunityId', concat('P', o_orderkey), 'ContactId', concat('K', o_custkey), 'IsPrimary', case when o_orderkey % 20 = 0 then 'true' else 'false' end) as values")))
    sequence = rows(spark, ["object", "load_order", "enabled", "manual_override_order"], [
        ("Contact", "10", "TRUE", None), ("Opportunity", "20", "TRUE", "5"), ("OpportunityContactRole", "30", "yes", None), ("Lead", "40", "FALSE", None), ("Asset", "50", "TRUE", None)])
    policy = rows(spark, ["object", "required_source"], [("Asset", "elsewhere"), ("Contact", "OLD")])
    return work, target, dict(catalog=field_catalog(spark, DEAL_CATALOG), rule_table=default_rules(spark), sequence=sequence, policy=policy)


def loaded(spark, sf):
    """Contacts first, in a call of their own; the second call takes up what is left."""
    work, target, options = deals(spark, sf)
    kept = work_folder(spark, "results")
    one = execute.run_load(work, target, only=rows(spark, ["object"], [("Contact",)]), store=kept, **options)
    return execute.run_load(work, one.target, store=kept, **options), kept


DEALS_SQL = f"""with d as (select cast(o_orderkey as varchar) as k, o_orderkey as n, o_orderstatus as name, o_custkey as c, o_orderkey % 5 = 0 as known, case when o_orderkey % 5 = 0 then concat('P', o_orderkey) else concat('T', o_orderkey) end as id,
     case when o_custkey % 4 = 0 then concat('T', o_custkey) when {KNOWN.format('o_custkey')} then concat('K', o_custkey) end as contact, o_orderkey % 10 = 0 and {KNOWN.format('o_custkey')} as held from orders)"""


@query(DEALS_SQL + """ select 'Contact' as target_object, cast(c_custkey as varchar) as source_record_id, concat('T', c_custkey) as target_record_id, 'upsert' as operation, 'TRUE' as success, concat('{"Name":"', c_name, '"}') as payload_json, '' as skipped_fields, '{}' as message
     from customer where c_custkey % 4 = 0
   union all select 'Opportunity', k, id, case when known then 'update' else 'upsert' end, 'TRUE', concat('{"Name":"', name, '"}'),
     case when contact is null then concat('Contact.External_Id__c=', c, ': related record not found in Contact') else 'ContactId: routed to the link object because the field is not writable here' end, '{}' from d
   union all select 'OpportunityContactRole', k, case when contact is null then '' when held then concat('L', k) else concat('T', k) end,
     case when contact is null then 'skip' when held and n % 20 = 0 then 'skip' when held then 'update' else 'create' end, case when contact is null then 'FALSE' else 'TRUE' end,
     case when contact is null or (held and n % 20 = 0) then '{}' when held then '{"IsPrimary":"true"}' else concat('{"ContactId":"', contact, '","IsPrimary":"true","OpportunityId":"', id, '"}') end,
     'Opportunity.ContactId routed into OpportunityContactRole',
     case when contact is null then concat('Cannot route Opportunity.ContactId because target Contact was not found for source id ', c) when held and n % 20 = 0 then 'OpportunityContactRole already exists and is primary; nothing written' else '{}' end from d""")
def load_results(spark, sf):
    _, kept = loaded(spark, sf)
    return result_store.last_outcomes(spark, kept).select("target_object", "source_record_id", "target_record_id", "operation", "success", "payload_json", "skipped_fields", "message")


@query(DEALS_SQL + f""" select 'Contact' as object, concat('K', c_custkey) as record_id, cast(c_custkey as varchar) as external_id, 'Name=old' as fields from customer where {KNOWN.format('c_custkey')}
   union all select 'Contact', concat('T', c_custkey), cast(c_custkey as varchar), concat('Name=', c_name) from customer where c_custkey % 4 = 0
   union all select 'Opportunity', id, k, concat('Name=', name) from d
   union all select 'OpportunityContactRole', case when held then concat('L', k) else concat('T', k) end, null, concat('ContactId=', contact, '|IsPrimary=true|OpportunityId=', id) from d where contact is not null""")
def load_target(spark, sf):
    done, _ = loaded(spark, sf)
    show = F.array_join(F.transform(F.sort_array(F.map_entries("values")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), "|")
    return done.target.select("object", "record_id", "external_id", show.alias("fields"))


SHIPPED_CATALOG = [("Subscriptions__c", "SL_Reason_for_Product_Change__c", "string", None, [], True, False, True, False), ("Account", "RecordTypeId", "reference", "RecordType", ["RecordType"], True, False, True, False)]


@query("""select cast(o_orderkey as varchar) as source_record_id, case o_orderkey % 3
     when 0 then concat_ws('|', case when op <> 'update' then 'Product2.External_Id__c=p' end, case when o_custkey % 2 <> 0 then 'TotalPrice=2' end, case when o_custkey % 2 = 0 then 'UnitPrice=1' end)
     when 1 then concat('Q=1', case when op <> 'update' then '|SL_Reason_for_Product_Change__c=Data Migration' else '' end)
     else concat('Q=1', case when op <> 'update' and o_custkey % 2 = 0 then '|RecordTypeId=RTB' else '' end) end as entries,
   case o_orderkey % 3 when 0 then concat_ws('; ', case when op = 'update' then 'Product2: catalogue reference is owned by the target system, not updated from the source' end, case when o_custkey % 2 = 0 then 'TotalPrice: only one of UnitPrice and TotalPrice may be given' end)
     when 1 then case when op <> 'update' then 'SL_Reason_for_Product_Change__c: defaulted to Data Migration' else '' end
     else case when op <> 'update' and o_custkey % 2 = 0 then 'RecordTypeId: defaulted to record type Brand' else '' end end as skipped
   from (select *, case when o_orderkey % 4 = 0 then 'update' when o_orderkey % 4 = 1 then 'create' else 'upsert' end as op from orders)""")
def shipped_rules(spark, sf):
    work = read(spark, sf, "orders").selectExpr(
        "case o_orderkey % 3 when 0 then 'OpportunityLineItem' when 1 then 'Subscriptions__c' else 'Account' end as target_object", "case when o_custkey % 2 = 0 then 'Brand__c' else 'Customer' end as source_object",
        "cast(o_orderkey as string) as source_record_id", "case when o_orderkey % 4 = 0 then concat('X', o_orderkey) end as target_record_id",
        "case when o_orderkey % 4 = 0 then 'update' when o_orderkey % 4 = 1 then 'create' else 'upsert' end as operation",
        f"case when o_orderkey % 3 <> 0 then array({_entry('Q', "'1'")}) when o_custkey % 2 = 0 then array({_entry('UnitPrice', "'1'")}, {_entry('TotalPrice', "'2'")}, {_entry('Product2', "'p'", "'External_Id__c'")}) "
        f"else array({_entry('TotalPrice', "'2'")}, {_entry('Product2', "'p'", "'External_Id__c'")}) end as entries", "cast(array() as array<string>) as skipped")
    types = rows(spark, ["object", "developer_name", "id"], [("Account", "Brand", "RTB")])
    out = apply_rules(work, default_rules(spark), field_catalog(spark, SHIPPED_CATALOG), types)
    return out.select("source_record_id", items_text(F.col("entries")).alias("entries"), F.array_join(F.sort_array("skipped"), "; ").alias("skipped"))


# --- stored results -------------------------------------------------------------------------------


def kept_errors(spark, sf):
    """All events fail in a first batch; those of every third id succeed in a second."""
    kept = work_folder(spark, "outcomes")
    e = read(spark, sf, "events").selectExpr(
        "'new' as target_env", "'old' as source_env", "cast(user_id as string) as target_object", "event_type as source_object", "concat('S', lpad(cast(event_id as string), 9, '0')) as source_record_id",
        "cast(event_id as string) as target_record_id", "'data_gap' as change_type", "case when event_id % 5 = 0 then 'skip' else 'update' end as operation", "'FALSE' as dry_run", "'FALSE' as success",
        "1 as payload_field_count", "props as payload_json", "'' as skipped_fields", f"{MESSAGES} as message", "event_id")
    result_store.keep_outcomes(e, kept)
    result_store.keep_outcomes(e.where("event_id % 3 = 0").withColumn("success", F.lit("TRUE")), kept)
    return kept


@query(f"""select target_object, source_object, operation, error_category, error_code, error_fields, error_message, count(*) as row_count, min(source_record_id) as sample_source_record_id,
   arg_min(props, source_record_id) as sample_payload_json, arg_min(m, source_record_id) as sample_message
   from (select *, nullif({MESSAGES.replace('cast(event_id as string)', 'cast(event_id as varchar)')}, '') as m from ({PARSED_SQL})) where event_id % 3 <> 0 group by 1, 2, 3, 4, 5, 6, 7""")
def stored_errors(spark, sf):
    summary, _ = result_store.error_report(spark, kept_errors(spark, sf))
    return summary.select(*errors.ERROR_KEY, "row_count", "sample_source_record_id", "sample_payload_json", F.nullif("sample_message", F.lit("")).alias("sample_message"))


@query("select cast(user_id as varchar) as target_object, 'S' || lpad(cast(event_id as varchar), 9, '0') as source_record_id from events where event_id % 3 <> 0")
def retry_list(spark, sf):
    return result_store.retry_list(spark, kept_errors(spark, sf)).select(*RECORD_KEY)
