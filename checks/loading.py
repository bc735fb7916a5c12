"""Mapping, resolution and load planning over the two-sided tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from twinledger.functions.payload import items_json, items_text
from twinledger.functions.text import name_candidates
from twinledger.functions.values import lookup_key
from twinledger.model import EXTERNAL_ID, catalog, rows
from twinledger.operators import mapping as mp, resolve
from twinledger.operators.ranking import first_wins
from twinledger.operators.rules import RULE_COLUMNS, apply_rules
from twinledger.operators.state import last_results, pending, restrict, totals
from twinledger.plans import execute, prepare
from twinledger.sources.scope import field_mappings

from .fixtures import MONEY, long_side, parity_sql, read, wide, wide_sql
from .parities import PAIR, both
from .registry import query

STAGE_MAP = json.dumps({"source": {"object": "Orders", "field": "Status"}, "target": {"object": "Sale", "field": "Stage"},
                        "mapping": {"F": "Finished", "O": "Open"}})

SCOPE = [
    ("Orders", "Status", "Sale", "Stage", None, STAGE_MAP),
    ("Orders", "Priority", "Sale", "Priority", "no", None),
    ("Orders", "Price", "Sale", "Amount", None, None),
    ("Orders", "Price", "Sale", "Rounded", None, None),
    ("Orders", "CustomerId", "Sale", "BuyerId", None, None),
    ("Orders", "CustomerId", "Sale", "Keeper.External_Id__c", None, None),
    ("Orders", "Price", "Sale", "Ignored", "Yes", None),
    ("Customer", "Name", "Account", "Name", None, None),
    ("Customer", "Balance", "Account", "Balance", None, None),
    ("Customer", "NationId", "Account", "NationId", None, None),
    ("Customer", "Segment", "Account", "Id", None, None),
]

CATALOG = [
    ("Sale", "External_Id__c", "string", None, [], True, True, True, True),
    ("Sale", "Stage", "string", None, [], True, True, True, False),
    ("Sale", "Priority", "string", None, [], True, False, True, False),
    ("Sale", "Amount", "currency", None, [], True, True, True, False),
    ("Sale", "Rounded", "int", None, [], True, True, True, False),
    ("Sale", "BuyerId", "reference", "Buyer", ["Account", "Lead"], True, True, True, False),
    ("Sale", "KeeperId", "reference", "Keeper", ["Account"], True, False, True, False),
    ("Account", "External_Id__c", "string", None, [], True, True, True, False),
    ("Account", "Name", "string", None, [], True, True, True, False),
    ("Account", "Balance", "double", None, [], True, False, True, False),
    ("Account", "NationId", "reference", "Nation", ["Nation"], True, True, False, False),
]


def scope(spark, extra=()):
    data = [(*r, i) for i, r in enumerate([*SCOPE, *extra])]
    return rows(spark, ["old_object", "old_field", "new_object", "new_field", "ignore", "value_map", "row_no"], data,
                "old_object string, old_field string, new_object string, new_field string, ignore string, value_map string, row_no long")


def field_catalog(spark, extra=()):
    return catalog(rows(spark, ["object", "field", "type", "relationship_name", "reference_to", "createable", "updateable", "nillable", "external_id"],
                        [*CATALOG, *extra], "object string, field string, type string, relationship_name string, reference_to array<string>, "
                                            "createable boolean, updateable boolean, nillable boolean, external_id boolean"))


def queue(spark, sf, objects=PAIR, **kw):
    return prepare.work_queue(both(spark, sf, objects).records, field_mappings(scope(spark)), **kw)


def prepared(spark, sf, objects=PAIR):
    return prepare.prepare_work(queue(spark, sf, objects), field_mappings(scope(spark)), field_catalog(spark))


# Shortest spelling of a two-digit decimal as a double.
FLOAT = "case when {0} like '%.00' then left({0}, length({0}) - 1) else rtrim({0}, '0') end"

WORK_SQL = parity_sql(PAIR) + f""", w as (
  select s.obj as source_object, case s.obj when 'Orders' then 'Sale' else 'Account' end as target_object, s.key as source_record_id, s.new_record_id as target_record_id,
    s.change_type, f.field, f.old_value as v, s.new_record_id is null as fresh,
    case when s.new_record_id is not null then 'update' when s.obj = 'Orders' then 'upsert' else 'create' end as operation
  from status s join fld f on f.obj = s.obj and f.key = s.key
  where s.change_type in ('data_gap', 'missing_from_new') and case when s.change_type = 'data_gap' then f.differs else f.in_old end),
pl as (
  select *, 'Stage' as name, null as ext, case v when 'F' then 'Finished' when 'O' then 'Open' else v end as value, null as skip, 0 as no from w where field = 'Status'
  union all select *, case when fresh then 'Priority' end, null, v, case when not fresh then 'Priority -> Priority: not writable or unsupported' end, 1 from w where field = 'Priority'
  union all select *, 'Amount', null, {FLOAT.format('v')}, null, 2 from w where field = 'Price'
  union all select *, 'Rounded', null, cast(cast(trunc(cast(v as double)) as bigint) as varchar), null, 3 from w where field = 'Price'
  union all select *, 'Buyer', 'External_Id__c', v, null, 4 from w where field = 'CustomerId'
  union all select *, case when fresh then 'Keeper' end, 'External_Id__c', v, case when not fresh then 'CustomerId -> Keeper.External_Id__c: not writable or unsupported' end, 5 from w where field = 'CustomerId'
  union all select *, 'Name', null, v, null, 7 from w where field = 'Name'
  union all select *, case when fresh then 'Balance' end, null, {FLOAT.format('v')}, case when not fresh then 'Balance -> Balance: not writable or unsupported' end, 8 from w where field = 'Balance'
  union all select *, 'Nation', 'External_Id__c', v, null, 9 from w where field = 'NationId'
  union all select *, null, null, v, 'Segment: target Id is not writable', 10 from w where field = 'Segment'),
pr as (select target_object, source_object, source_record_id, target_record_id, change_type, operation, fresh,
    coalesce(string_agg(concat(name, case when ext is null then '' else concat('.', ext) end, '=', coalesce(value, '<null>')), '|'
      order by concat(name, case when ext is null then '' else concat('.', ext) end, '=', coalesce(value, '<null>'))) filter (name is not null), '') as entries,
    coalesce(string_agg(skip, '; ' order by field, no), '') as skipped
  from pl group by 1, 2, 3, 4, 5, 6, 7)
"""


@query(parity_sql(PAIR) + """select case s.obj when 'Orders' then 'Sale' else 'Account' end as target_object, s.obj as source_object, s.key as source_record_id,
   s.new_record_id as target_record_id, s.change_type, string_agg(concat(f.field, '=', coalesce(f.old_value, '-')), '|' order by f.field) as payload
   from status s join fld f on f.obj = s.obj and f.key = s.key where s.change_type in ('data_gap', 'missing_from_new')
   and case when s.change_type = 'data_gap' then f.differs else f.in_old end group by 1, 2, 3, 4, 5""")
def work_queue(spark, sf):
    show = F.array_join(F.transform(F.sort_array(F.map_entries("payload")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), "|")
    return queue(spark, sf).select(*execute.WORK_COLUMNS, show.alias("payload"))


@query(WORK_SQL + "select target_object, source_record_id, operation, entries, skipped from pr where entries <> ''")
def map_payload(spark, sf):
    return prepared(spark, sf).work.select("target_object", "source_record_id", "operation", items_text(F.col("entries")).alias("entries"),
                                           F.array_join("skipped", "; ").alias("skipped"))


@query(WORK_SQL + "select target_object, source_record_id, skipped from pr where entries = ''")
def closed_work(spark, sf):
    return prepared(spark, sf).closed.select("target_object", "source_record_id", F.array_join("skipped", "; ").alias("skipped"))


@query(WORK_SQL + "select target_object, change_type, operation, count(*) as n from pr group by 1, 2, 3")
def operations(spark, sf):
    done = prepare.with_operation(queue(spark, sf), field_catalog(spark))
    return done.groupBy("target_object", "change_type", "operation").agg(F.count("*").alias("n"))


@query(WORK_SQL + """select target_object, source_object, source_record_id, coalesce(target_record_id, '') as target_record_id, change_type, operation, 'pending' as status,
   case when operation = 'update' or target_object = 'Account' then null else source_record_id end as keyed from pr where entries <> ''""")
def prepared_work(spark, sf):
    s = prepared(spark, sf).stored()
    keyed = F.when((F.col("operation") == "upsert") & F.from_json("payload_json", "map<string,string>").isNotNull(), F.col("source_record_id"))
    return s.select("target_object", "source_object", "source_record_id", "target_record_id", "change_type", "operation", "status", keyed.alias("keyed"))


EARLIER = "cast(source_record_id as bigint) % 7 = 0"


@query(WORK_SQL + f"""select target_object, count(*) as prepared_rows, count(*) filter (not {EARLIER}) as pending_rows, 'prepared' as status from pr where entries <> '' group by 1""")
def prepared_summary(spark, sf):
    work = prepared(spark, sf).work
    done = read(spark, sf, "orders").where("o_orderkey % 7 = 0").selectExpr("'Sale' as target_object", "cast(o_orderkey as string) as source_record_id", "'FALSE' as success").unionByName(
        read(spark, sf, "customer").where("c_custkey % 7 = 0").selectExpr("'Account' as target_object", "cast(c_custkey as string) as source_record_id", "'TRUE' as success"))
    return prepare.prepared_summary(work, done)


@query("""select o_orderkey, coalesce(case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' end, o_orderstatus) as direct,
   coalesce(case case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' else o_orderstatus end when 'Finished' then 'F' when 'Open' then 'O' end, o_orderstatus) as inverse from orders""")
def value_map(spark, sf):
    s = scope(spark)
    direct = mp.map_fields(read(spark, sf, "orders").selectExpr("o_orderkey", "'Orders' as source_object", "'Status' as source_field", "o_orderstatus as value"),
                           field_mappings(s)).select("o_orderkey", F.col("mapped_value").alias("direct"))
    back = mp.map_fields(direct.selectExpr("o_orderkey", "direct", "'Sale' as source_object", "'Stage' as source_field", "direct as value"),
                         field_mappings(s, "new_to_old"))
    return back.select("o_orderkey", "direct", F.col("mapped_value").alias("inverse"))


@query("""select p_partkey, x as field, c.name, c.pos from (select p_partkey, case when p_partkey % 4 = 0 then 'Id' when p_partkey % 4 = 1 then concat(p_type, '__c') else concat(upper(left(p_name, 1)), substr(replace(p_name, ' ', ''), 2), 'Of', p_brand) end as x from part) t,
   lateral (select 0 as pos, 'External_Id__c' as name where x = 'Id' union all select 1, 'Line_Item_Schedule_Id__c' where x = 'Id'
     union all select 0, x where x <> 'Id' union all select 1, concat(x, '__c') where x <> 'Id' and x not like '%\\_\\_c' escape '\\'
     union all select 2, concat(ltrim(regexp_replace(x, '([A-Z])', '_\\1', 'g'), '_'), '__c') where x <> 'Id' and x not like '%\\_\\_c' escape '\\' and ltrim(regexp_replace(x, '([A-Z])', '_\\1', 'g'), '_') <> x) c""")
def inferred_names(spark, sf):
    x = ("case when p_partkey % 4 = 0 then 'Id' when p_partkey % 4 = 1 then concat(p_type, '__c') else concat(upper(left(p_name, 1)), "
         "substr(replace(p_name, ' ', ''), 2), 'Of', p_brand) end")
    df = read(spark, sf, "part").selectExpr("p_partkey", f"{x} as field")
    return df.select("p_partkey", "field", F.posexplode(name_candidates(F.col("field"))).alias("pos", "name"))


COPY_SCOPE = [("Orders", "Status", "Order_Copy__c", "Gone", None, None)]
COPY_CATALOG = [
    ("Order_Copy__c", "Status__c", "string", None, [], True, True, True, False),
    ("Order_Copy__c", "Priority", "string", None, [], True, True, True, False),
    ("Order_Copy__c", "Buyer__c", "reference", "Buyer__r", ["Account"], True, True, True, False),
]


@query(parity_sql(("Orders",)) + """select s.key as source_record_id,
     string_agg(case field when 'Status' then concat('Status__c=', old_value) when 'Priority' then concat('Priority=', old_value)
        when 'CustomerId' then concat('Buyer__r.External_Id__c=', old_value) end, '|' order by case field when 'Status' then 3 when 'Priority' then 2 else 1 end) as entries,
     string_agg(case field when 'Status' then 'Status -> Gone: not available; used inferred target field' when 'Price' then 'Price: no metadata mapping' end, '; ' order by field) as skipped
   from status s join fld f on f.obj = s.obj and f.key = s.key where s.change_type in ('data_gap', 'missing_from_new')
   and case when s.change_type = 'data_gap' then f.differs else f.in_old end group by 1
   having count(*) filter (field <> 'Price') > 0""")
def inferred_payload(spark, sf):
    m = field_mappings(scope(spark, COPY_SCOPE)).filter("target_object = 'Order_Copy__c'")
    pairs = rows(spark, ["source_object", "target_object", "reference_field", "reference_object"], [("Orders", "Order_Copy__c", "CustomerId", "Account")])
    q = prepare.work_queue(both(spark, sf, ("Orders",)).records, m)
    p = prepare.prepare_work(q, m, field_catalog(spark, COPY_CATALOG), pairs).work
    return p.select("source_record_id", items_text(F.col("entries")).alias("entries"), F.array_join("skipped", "; ").alias("skipped"))


@query(parity_sql(PAIR) + """, t as (select s.obj as new_object, case s.obj when 'Orders' then 'Sale' else 'Account' end as old_object, s.new_record_id, s.external_id, s.change_type,
     case when s.old_record_id is not null or s.external_id <> s.new_record_id then 'update' else 'create' end as operation,
     coalesce(s.old_record_id, s.external_id) as old_record_id, f.field, f.new_value
     from status s join fld f on f.obj = s.obj and f.key = s.key where s.change_type in ('data_gap', 'missing_from_old') and case when s.change_type = 'data_gap' then f.differs else f.in_new end),
   m as (select *, case field when 'Status' then 'Stage' when 'Price' then 'Amount' when 'CustomerId' then 'BuyerId' when 'Name' then 'Name' when 'Balance' then 'Balance' end as target from t)
   select operation, new_object, old_object, new_record_id, old_record_id, external_id, change_type,
     string_agg(concat(target, '=', coalesce(new_value, '-')), '|' order by target) filter (target is not null) as payload,
     coalesce(string_agg(field, ';' order by field) filter (target is null and field <> 'Segment'), '') as unmapped
   from m group by 1, 2, 3, 4, 5, 6, 7 having count(target) > 0""")
def reverse_transform(spark, sf):
    back = rows(spark, ["source_object", "source_field", "target_object", "target_field", "value_map", "row_no"], [
        ("Orders", "Status", "Sale", "Stage", None, 0), ("Orders", "Price", "Sale", "Amount", None, 1), ("Orders", "CustomerId", "Sale", "BuyerId", None, 2),
        ("Customer", "Name", "Account", "Name", None, 3), ("Customer", "Balance", "Account", "Balance", None, 4), ("Customer", "Segment", "Account", "Id", None, 5)],
        "source_object string, source_field string, target_object string, target_field string, value_map string, row_no long")
    out = mp.reverse_transform(both(spark, sf).records, back)
    show = F.array_join(F.transform(F.sort_array(F.map_entries("payload")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), "|")
    return out.select("operation", "new_object", "old_object", "new_record_id", "old_record_id", "external_id", "change_type",
                      show.alias("payload"), F.array_join("unmapped_fields", ";").alias("unmapped"))


# --- looking up ids -----------------------------------------------------------------

# Accounts come from the new side's customers, leads from suppliers, and every seventh
# customer was loaded earlier in the run.
def id_maps(spark, sf):
    accounts = long_side(spark, sf, "new", ("Customer",)).selectExpr("'Account' as obj", "record_id", "external_id")
    leads = read(spark, sf, "supplier").selectExpr("'Lead' as obj", "concat('L', cast(s_suppkey as string)) as record_id", "cast(s_suppkey as string) as external_id")
    nations = read(spark, sf, "nation").where("n_nationkey % 6 <> 0").selectExpr(
        "'Nation' as obj", "concat('C', cast(n_nationkey as string)) as record_id", "cast(n_nationkey as string) as external_id")
    held = resolve.id_map_from_extract(accounts.unionByName(leads).unionByName(nations))
    loaded = resolve.id_map_from_results(read(spark, sf, "customer").where("c_custkey % 7 = 0").selectExpr(
        "'Account' as target_object", "cast(c_custkey as string) as source_record_id", "concat('R', cast(c_custkey as string)) as target_record_id",
        "case when c_custkey % 2 = 0 then 'TRUE' else 'FALSE' end as success"))
    return held.unionByName(loaded)


IDS_SQL = f"""ids as (select k, coalesce(run_id, acc_id) as account_id, lead_id from (select cast(c_custkey as string) as k from customer) c
   left join (select External_Id__c as e, min(Id) as acc_id from ({wide_sql('Customer', 'new')}) where External_Id__c is not null group by 1) a on a.e = c.k
   left join (select cast(c_custkey as string) as r, concat('R', cast(c_custkey as string)) as run_id from customer where c_custkey % 14 = 0) r on r.r = c.k
   left join (select cast(s_suppkey as string) as s, concat('L', cast(s_suppkey as string)) as lead_id from supplier) s on s.s = c.k),
nat as (select cast(n_nationkey as string) as k, concat('C', cast(n_nationkey as string)) as id from nation where n_nationkey % 6 <> 0)"""


@query("""select 'Part' as object, ext_id, min(id) as target_id from (select cast(l_partkey as string) as ext_id,
   concat('P', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as id from lineitem) group by 1, 2""")
def id_lookup(spark, sf):
    df = read(spark, sf, "lineitem").selectExpr("'Part' as obj", "cast(l_partkey as string) as external_id",
                                                "concat('P', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as record_id")
    return resolve.id_map_from_extract(df).drop("origin")


@query("""select event_type as object, cast(user_id as varchar) as ext_id, arg_max(concat('T', cast(event_id as varchar)), event_id) as target_id
   from events where event_type <> 'error' and event_id % 10 <> 0 group by 1, 2""")
def seeded_ids(spark, sf):
    e = read(spark, sf, "events").selectExpr(
        "event_type as target_object", "cast(user_id as string) as source_record_id", "case when event_id % 10 = 0 then '' else concat('T', cast(event_id as string)) end as target_record_id",
        "case when event_type = 'error' then 'FALSE' else 'true' end as success", "event_id as seq")
    return resolve.id_map_from_results(e).drop("origin")


@query("""select p_brand as object, p_type as developer_name, coalesce(arg_max(cast(p_partkey as varchar), p_partkey) filter (p_size % 2 = 0), arg_min(cast(p_partkey as varchar), p_partkey)) as id from part group by 1, 2""")
def active_lookup(spark, sf):
    return resolve.active_ids(read(spark, sf, "part").selectExpr(
        "p_brand as object", "p_type as developer_name", "cast(p_partkey as string) as id", "p_size % 2 = 0 as is_active", "p_partkey as row_no"))


@query(WORK_SQL + """select distinct w.target_object, w.source_record_id, w.change_type from w join (select distinct cast(o_custkey as varchar) as k from orders) o on o.k = w.source_record_id and w.target_object = 'Account'""")
def point_fetch(spark, sf):
    wanted = read(spark, sf, "orders").selectExpr("'Account' as object", "cast(o_custkey as string) as record_id")
    return resolve.point_fetch(queue(spark, sf), wanted).select("target_object", "source_record_id", "change_type")


@query(f"""with {IDS_SQL} select cast(o_orderkey as varchar) as source_record_id, case when i.account_id is not null then 'update' else 'create' end as operation, i.account_id as target_record_id
   from orders left join ids i on i.k = cast(o_custkey as varchar)""")
def create_to_update(spark, sf):
    work = read(spark, sf, "orders").selectExpr("'Account' as target_object", "cast(o_custkey as string) as source_record_id", "cast(null as string) as target_record_id",
                                                "'create' as operation", "cast(o_orderkey as string) as o")
    return resolve.create_to_update(work, id_maps(spark, sf)).select(F.col("o").alias("source_record_id"), "operation", "target_record_id")


RESOLVED_SQL = WORK_SQL + f""", {IDS_SQL},
rs as (select pl.* exclude (name, ext, value, skip),
   case when name = 'Buyer' then case when v is null or coalesce(i.account_id, i.lead_id) is not null then 'BuyerId' end
        when name = 'Keeper' then case when v is null or i.account_id is not null then 'KeeperId' end
        when name = 'Nation' then case when nat.id is not null then 'NationId' end else name end as name,
   case when name = 'Buyer' then coalesce(i.account_id, i.lead_id) when name = 'Keeper' then i.account_id when name = 'Nation' then nat.id else value end as value,
   skip,
   case when name = 'Buyer' and coalesce(i.account_id, i.lead_id) is null then concat('Buyer.External_Id__c=', v, ': related record not found in Account; Lead')
        when name = 'Keeper' and i.account_id is null then concat('Keeper.External_Id__c=', v, ': related record not found in Account')
        when name = 'Nation' and nat.id is null then concat('Nation.External_Id__c=', v, ': related record not found in Nation') end as miss
   from pl left join ids i on i.k = pl.v and pl.field = 'CustomerId' left join nat on nat.k = pl.v and pl.field = 'NationId'
   where (target_object, source_record_id) in (select (target_object, source_record_id) from pr where entries <> '')),
rp as (select target_object, source_object, source_record_id, target_record_id, change_type, operation,
    coalesce(string_agg(concat(name, '=', coalesce(value, '<null>')), '|' order by concat(name, '=', coalesce(value, '<null>'))) filter (name is not null), '') as entries,
    concat_ws('; ', string_agg(skip, '; ' order by field, no), string_agg(miss, '; ' order by miss)) as skipped,
    count(name) as n_fields
  from rs group by 1, 2, 3, 4, 5, 6)
"""


@query(RESOLVED_SQL + "select target_object, source_record_id, operation, entries, coalesce(skipped, '') as skipped from rp")
def resolve_refs(spark, sf):
    out = resolve.resolve_references(prepared(spark, sf).work, field_catalog(spark), id_maps(spark, sf))
    return out.select("target_object", "source_record_id", "operation", items_text(F.col("entries")).alias("entries"), F.array_join("skipped", "; ").alias("skipped"))


RULES = [
    ("Sale", None, "any", "Rounded", "drop", "Amount", None, "only one of the two"),
    ("Sale", None, "update", "Stage", "drop", None, None, "kept by the target"),
    ("Sale", None, "any", "Priority", "default", None, "5-LOW", "defaulted"),
    ("Account", "Customer", "hint_create", "NationId", "record_type", None, "Main", "defaulted to Main"),
]
RULE_TYPES = ", ".join(f"{c} string" for c in RULE_COLUMNS)


@query(RESOLVED_SQL + """, x as (select target_object, source_record_id, operation, fresh, name, value from rs where name is not null
     and not (target_object = 'Sale' and name = 'Rounded') and not (name = 'Stage' and operation = 'update')
   union all select distinct target_object, source_record_id, operation, fresh, 'Priority', '5-LOW' from rs r where target_object = 'Sale' and fresh
     and not exists (select 1 from rs q where q.target_object = r.target_object and q.source_record_id = r.source_record_id and q.name = 'Priority')
   union all select distinct target_object, source_record_id, operation, fresh, 'NationId', 'RT9' from rs r where target_object = 'Account' and fresh
     and not exists (select 1 from rs q where q.target_object = r.target_object and q.source_record_id = r.source_record_id and q.name = 'NationId'))
   select target_object, source_record_id, operation, string_agg(concat(name, '=', coalesce(value, '<null>')), '|' order by concat(name, '=', coalesce(value, '<null>'))) as entries from x group by 1, 2, 3""")
def payload_rules(spark, sf):
    done = resolve.resolve_references(prepared(spark, sf).work, field_catalog(spark), id_maps(spark, sf))
    types = rows(spark, ["object", "developer_name", "id"], [("Account", "Main", "RT9")])
    out = apply_rules(done, rows(spark, RULE_COLUMNS, RULES, RULE_TYPES), field_catalog(spark), types)
    return out.filter(F.size("entries") > 0).select("target_object", "source_record_id", "operation", items_text(F.col("entries")).alias("entries"))


@query("""with links as (select cast(l_orderkey as varchar) as k1, cast(l_partkey as varchar) as k2, l_returnflag as k3, concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as id from lineitem),
   ask as (select cast(l_orderkey as varchar) || '/' || cast(l_linenumber as varchar) || '/' || cast(l_suppkey as varchar) || '/' || cast(l_partkey as varchar) as source_record_id, cast(l_orderkey as varchar) as k1,
      cast(case when l_linenumber % 2 = 0 then l_partkey else l_partkey + 1 end as varchar) as k2, case when l_linenumber % 3 = 0 then '' when l_linenumber % 3 = 1 then l_returnflag else 'Z' end as k3 from lineitem),
   a as (select distinct * from ask)
   select a.source_record_id, case when a.k3 = '' then (select min(id) from links l where l.k1 = a.k1 and l.k2 = a.k2) else (select min(id) from links l where l.k1 = a.k1 and l.k2 = a.k2 and l.k3 = a.k3) end as natural_id from a""")
def natural_key(spark, sf):
    li = read(spark, sf, "lineitem")
    links = li.selectExpr("'OrderPart' as target_object", "cast(l_orderkey as string) as k1", "cast(l_partkey as string) as k2", "l_returnflag as k3",
                          "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as target_id")
    entry = lambda n, e: f"named_struct('name', '{n}', 'ext_field', cast(null as string), 'value', {e})"
    ask = li.selectExpr(
        "'OrderPart' as target_object", "concat_ws('/', l_orderkey, l_linenumber, l_suppkey, l_partkey) as source_record_id",
        f"array({entry('Main', 'cast(l_orderkey as string)')}, {entry('Second', 'cast(case when l_linenumber % 2 = 0 then l_partkey else l_partkey + 1 end as string)')}, "
        f"""{entry('Kind', "case when l_linenumber % 3 = 0 then '' when l_linenumber % 3 = 1 then l_returnflag else 'Z' end")}) as entries""").distinct()
    keys = rows(spark, ["target_object", "key_1", "key_2", "key_3"], [("OrderPart", "Main", "Second", "Kind"), ("Other", "A", "B", None)])
    return resolve.natural_key_match(ask, links, keys).select("source_record_id", "natural_id")


# --- operations ------------------------------------------------------------------------


def new_target(spark, sf):
    """The new side as the target: object names and fields after mapping."""
    sale = wide(spark, sf, "Orders", "new").selectExpr(
        "'Sale' as object", "Id as record_id", "External_Id__c as external_id",
        "map('Stage', Status, 'Priority', Priority, 'Amount', Price, 'BuyerId', CustomerId) as values")
    account = wide(spark, sf, "Customer", "new").selectExpr(
        "'Account' as object", "Id as record_id", "External_Id__c as external_id", "map('Name', Name, 'Balance', Balance, 'NationId', NationId) as values")
    return sale.unionByName(account)


def planned(spark, sf, **kw):
    return execute.plan_operations(prepared(spark, sf).work, field_catalog(spark), id_maps(spark, sf), rows(spark, RULE_COLUMNS, [], RULE_TYPES), **kw)


PLAN_SQL = RESOLVED_SQL + """, op as (select target_object, source_object, source_record_id, target_record_id, change_type,
   case when entries = '' then 'skip' else operation end as operation,
   case when operation = 'create' and entries <> '' then array_to_string(list_sort(list_append(string_split(entries, '|'), concat('External_Id__c=', source_record_id))), '|') else entries end as entries,
   case when entries = '' then 'skipped' else 'ready' end as status,
   case when entries = '' then 'No writable prepared payload after relationship resolution/rules' end as message from rp)
"""


@query(PLAN_SQL + "select * from op")
def plan_operations(spark, sf):
    return planned(spark, sf).select(*execute.WORK_COLUMNS, "operation", items_text(F.col("entries")).alias("entries"), "status", "message")


@query(PLAN_SQL + """select target_object, operation, source_record_id, cast(floor((row_number() over (partition by target_object, operation order by source_record_id) - 1) / 50) as bigint) as batch_no from op where status = 'ready'""")
def batches(spark, sf):
    return execute.batched(planned(spark, sf), 50).select("target_object", "operation", "source_record_id", "batch_no")


@query(PLAN_SQL + """select target_object, source_record_id, array_to_string(list_sort(case operation when 'update' then list_append(string_split(entries, '|'), concat('Id=', target_record_id))
   when 'upsert' then list_append(string_split(entries, '|'), concat('External_Id__c=', source_record_id)) else string_split(entries, '|') end), '|') as payload from op where status = 'ready'""")
def operation_payload(spark, sf):
    ready = planned(spark, sf).filter("status = 'ready'")
    return execute.write_payload(ready).select("target_object", "source_record_id", items_text(F.col("write_entries")).alias("payload"))


# Customers missing from the new side are matched back to it by name and checked field by field.
@query(f"""with t as ({wide_sql('Customer', 'new')}), s as (select cast(c_custkey as varchar) as k, concat('N', cast(c_custkey as varchar)) as tid, c_name, {MONEY.format('c_acctbal')} as bal, cast(c_nationkey as varchar) as nat from customer where c_custkey % 13 <> 0)
   select k as source_record_id, concat_ws('|', case when t.Id is null or try_cast(t.Balance as double) is distinct from cast(bal as double) then concat('Balance=', bal) end,
      case when t.Id is null or t.Name is null or trim(t.Name) <> c_name then concat('Name=', c_name) end, case when t.Id is null or t.NationId <> nat then concat('NationId=', nat) end) as entries
   from s left join t on t.Id = s.tid""")
def actual_delta(spark, sf):
    from twinledger.operators.deltas import actual_deltas
    entry = lambda n: f"named_struct('name', '{n}', 'ext_field', cast(null as string), 'value', {n})"
    ops = wide(spark, sf, "Customer", "old").selectExpr(
        "'Account' as target_object", "Id as source_record_id", "concat('N', Id) as target_record_id",
        f"array({entry('Balance')}, {entry('Name')}, {entry('NationId')}) as entries", "cast(array() as array<string>) as skipped")
    out = actual_deltas(ops, new_target(spark, sf), field_catalog(spark), F.lit(True))
    return out.select("source_record_id", items_text(F.col("entries")).alias("entries"))


APPLY_SQL = PLAN_SQL + f""", tgt as (select 'Sale' as object, Id as record_id, External_Id__c as external_id from ({wide_sql('Orders', 'new')})
   union all select 'Account', Id, External_Id__c from ({wide_sql('Customer', 'new')})),
res as (select op.*, case when status = 'skipped' then coalesce(target_record_id, '') when op.operation = 'update' then target_record_id
    else concat('T', source_record_id) end as landed, case when status = 'skipped' then 0 when op.operation = 'upsert' then len(string_split(entries, '|')) else len(string_split(entries, '|')) end as n_entries from op)
"""


@query(APPLY_SQL + """select target_object, source_object, source_record_id, landed as target_record_id, change_type, operation, 'FALSE' as dry_run, 'TRUE' as success,
   cast(n_entries as bigint) as payload_field_count, case when status = 'skipped' then message else '{}' end as message from res""")
def apply_operations(spark, sf):
    done = execute.apply_operations(new_target(spark, sf), planned(spark, sf))
    return done.results.select("target_object", "source_object", "source_record_id", "target_record_id", "change_type", "operation", "dry_run", "success",
                               F.col("payload_field_count").cast("long").alias("payload_field_count"), "message")


@query(APPLY_SQL + """, ch as (select target_object as object, landed as record_id, source_record_id as ext, operation, unnest(string_split(entries, '|')) as e from res where status = 'ready'),
   base as (select 'Sale' as object, Id as record_id, External_Id__c as external_id, unnest(['Stage', 'Priority', 'Amount', 'BuyerId']) as name, unnest([Status, Priority, Price, CustomerId]) as value from (""" + wide_sql("Orders", "new") + """)
     union all select 'Account', Id, External_Id__c, unnest(['Name', 'Balance', 'NationId']), unnest([Name, Balance, NationId]) from (""" + wide_sql("Customer", "new") + """)),
   wr as (select object, record_id, ext, operation, split_part(e, '=', 1) as name, nullif(substr(e, instr(e, '=') + 1), '<null>') as value from ch),
   fin as (select coalesce(b.object, w.object) as object, coalesce(b.record_id, w.record_id) as record_id, coalesce(b.name, w.name) as name, case when w.name is not null then w.value else b.value end as value
     from base b full outer join (select * from wr where name <> 'External_Id__c') w on w.object = b.object and w.record_id = b.record_id and w.name = b.name)
   select f.object, f.record_id, coalesce(t.external_id, x.ext) as external_id, string_agg(concat(f.name, '=', coalesce(f.value, '-')), '|' order by f.name) as fields
   from fin f left join tgt t on t.object = f.object and t.record_id = f.record_id left join (select distinct object, record_id, ext from wr where operation in ('upsert', 'create')) x on x.object = f.object and x.record_id = f.record_id
   group by 1, 2, 3""")
def applied_target(spark, sf):
    done = execute.apply_operations(new_target(spark, sf), planned(spark, sf))
    show = F.array_join(F.transform(F.sort_array(F.map_entries("values")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), "|")
    return done.target.select("object", "record_id", "external_id", show.alias("fields"))


@query(APPLY_SQL + "select target_object, operation, count(*) as n, 'TRUE' as dry_run from res where status = 'ready' group by 1, 2")
def dry_run(spark, sf):
    done = execute.apply_operations(new_target(spark, sf), planned(spark, sf), dry_run=True)
    return done.results.filter("message like 'Dry run%'").groupBy("target_object", "operation", "dry_run").agg(F.count("*").alias("n"))


@query(parity_sql(PAIR) + "select s.obj, count(*) as loaded from status s where change_type = 'missing_from_new' and obj = 'Orders' group by 1")
def end_to_end(spark, sf):
    """Diff, prepare, load parents first, diff again: nothing is missing any more."""
    done = execute.run_load(prepared(spark, sf).work, new_target(spark, sf), field_catalog(spark), rows(spark, RULE_COLUMNS, [], RULE_TYPES))
    made = done.results.filter("success = 'TRUE' and operation = 'upsert' and target_object = 'Sale'").select(F.col("source_record_id").alias("k"))
    held = done.target.filter("object = 'Sale'").select(F.col("external_id").alias("k"))
    return made.join(held, "k", "left_semi").agg(F.count("*").alias("loaded")).select(F.lit("Orders").alias("obj"), "loaded")


# --- result state ------------------------------------------------------------------------


def event_results(spark, sf):
    """Events as load results: the user is the target object, the event type its record."""
    return read(spark, sf, "events").selectExpr(
        "cast(user_id as string) as target_object", "event_type as source_record_id", "concat('T', cast(event_id as string)) as target_record_id",
        "case when event_id % 3 = 0 then 'skip' else 'update' end as operation", "case when event_type = 'error' or event_id % 5 = 0 then 'FALSE' else 'TRUE' end as success", "event_id as seq", "event_type as change_type")


EVENT_SQL = """r as (select cast(user_id as varchar) as target_object, event_type as source_record_id, concat('T', cast(event_id as varchar)) as target_record_id,
   case when event_id % 3 = 0 then 'skip' else 'update' end as operation, case when event_type = 'error' or event_id % 5 = 0 then 'FALSE' else 'TRUE' end as success, event_id as seq from events),
 last as (select * from r qualify row_number() over (partition by target_object, source_record_id order by seq desc) = 1)"""


@query(f"with {EVENT_SQL} select target_object, source_record_id, target_record_id, operation, success, seq from last")
def last_result(spark, sf):
    return last_results(event_results(spark, sf).drop("change_type"))


@query(f"""with {EVENT_SQL}, w as (select cast(c_custkey as varchar) as target_object, 'error' as source_record_id from customer union all select cast(c_custkey as varchar), 'signup' from customer)
   select w.* from w where not exists (select 1 from r where r.target_object = w.target_object and r.source_record_id = w.source_record_id)""")
def pending_work(spark, sf):
    return pending(customer_work(spark, sf), event_results(spark, sf))


def customer_work(spark, sf):
    c = read(spark, sf, "customer").selectExpr("cast(c_custkey as string) as target_object")
    return c.select("target_object", F.explode(F.array(F.lit("error"), F.lit("signup"))).alias("source_record_id"))


@query(f"""with {EVENT_SQL}, w as (select cast(c_custkey as varchar) as target_object, 'error' as source_record_id from customer union all select cast(c_custkey as varchar), 'signup' from customer)
   select w.* from w where not exists (select 1 from last r where r.target_object = w.target_object and r.source_record_id = w.source_record_id and success = 'TRUE')""")
def retry_work(spark, sf):
    return pending(customer_work(spark, sf), event_results(spark, sf), retry_failed=True)


@query(f"""with {EVENT_SQL} select distinct w.target_object, w.source_record_id from (select cast(c_custkey as varchar) as target_object, 'error' as source_record_id from customer union all select cast(c_custkey as varchar), 'signup' from customer) w
   join r on r.target_object = w.target_object and r.source_record_id = w.source_record_id""")
def sample_restrict(spark, sf):
    return restrict(customer_work(spark, sf), event_results(spark, sf))


@query("""select cast(l_orderkey as varchar) as target_object, cast(l_linenumber as varchar) as source_record_id, cast(min(l_partkey * 100000 + l_suppkey) as bigint) as place from lineitem group by 1, 2""")
def queue_dedup(spark, sf):
    li = read(spark, sf, "lineitem").selectExpr("cast(l_orderkey as string) as target_object", "cast(l_linenumber as string) as source_record_id", "l_partkey * 100000 + l_suppkey as place")
    return first_wins(li, ["target_object", "source_record_id"], ["place"])


@query(f"""with {EVENT_SQL} select target_object, source_record_id as change_type, count(*) filter (not (operation = 'skip' and success = 'TRUE')) as attempted,
   count(*) filter (success = 'TRUE' and operation <> 'skip') as succeeded, count(*) filter (success <> 'TRUE') as failed, count(*) filter (success = 'TRUE' and operation = 'skip') as skipped from r group by 1, 2""")
def result_totals(spark, sf):
    return totals(event_results(spark, sf))
