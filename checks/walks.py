"""Graphs, samples, links, owners, one-table moves, errors and streams."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from twinledger.functions.payload import items_text
from twinledger.model import catalog, rows
from twinledger.operators import errors, graph, links as lk, sample
from twinledger.operators.rules import default_rules
from twinledger.plans import migrate, owners
from twinledger.session import work_folder
from twinledger.streaming import jobs

from .fixtures import long_side, long_sql, read
from .loading import WORK_SQL, field_catalog, prepared
from .registry import query

# --- object graph: regions, nations, customers and suppliers as objects --------------------

REFERENCES = [  # table, condition, object, field, relation, referenced objects
    ("nation", "true", "concat('N', n_nationkey)", "RegionId", "Region", ["concat('R', n_regionkey)"]),
    ("customer", "true", "concat('C', c_custkey)", "NationId", "Nation", ["concat('N', c_nationkey)"]),
    ("customer", "c_custkey % 10 = 0", "concat('C', c_custkey)", "SelfId", "Self", ["concat('C', c_custkey)"]),
    ("customer", "c_custkey % 7 = 0", "concat('C', c_custkey)", "OutId", "Out", ["'Outside'", "concat('N', c_nationkey)"]),
    ("customer", "c_custkey % 20 = 1", "concat('C', c_custkey)", "NextId", "Next", ["concat('C', c_custkey + 1)"]),
    ("customer", "c_custkey % 20 in (2, 3)", "concat('C', c_custkey)", "NextId", "Next", ["concat('C', c_custkey - 1)"]),
    ("supplier", "true", "concat('S', s_suppkey)", "NationId", "Nation", ["concat('N', s_nationkey)"]),
]


def object_catalog(spark, sf):
    out = read(spark, sf, "region").selectExpr("concat('R', r_regionkey) as object", "'Name' as field", "'string' as type",
                                               "cast(null as string) as relationship_name", "cast(array() as array<string>) as reference_to")
    for table, where, obj, field, relation, targets in REFERENCES:
        out = out.unionByName(read(spark, sf, table).where(where).selectExpr(
            f"{obj} as object", f"'{field}' as field", "'reference' as type", f"'{relation}' as relationship_name", f"array({', '.join(targets)}) as reference_to"))
    return catalog(out)


def object_scope(spark, sf):
    """Nations are in scope through a dotted field, everything else by field name."""
    c = object_catalog(spark, sf)
    return c.select("object", F.when(F.col("field") == "RegionId", "Region.Name").otherwise(F.col("field")).alias("field"))


EDGES_SQL = "select object, field, dependency_object, case when dependency_object = 'Outside' then 'external' else 'scoped' end as dependency_scope from (" + " union ".join(
    f"select {obj} as object, '{field}' as field, {t} as dependency_object from {table} where {where}"
    for table, where, obj, field, _, targets in REFERENCES for t in targets) + ")"


def object_edges(spark, sf):
    return graph.dependency_edges(object_catalog(spark, sf), object_scope(spark, sf))


@query(EDGES_SQL)
def dependency_edges(spark, sf):
    return object_edges(spark, sf)


ORDER_SQL = """with o0 as (select concat('R', r_regionkey) as object, row_number() over (order by concat('R', r_regionkey)) as pos from region),
 o1 as (select object, n0 + row_number() over (order by dep, object) as pos from (select concat('N', n_nationkey) as object, o0.pos as dep, (select count(*) from o0) as n0
   from nation join o0 on o0.object = concat('R', n_regionkey))),
 o2 as (select object, n1 + row_number() over (order by dep, object) as pos from (
   select x.object, o1.pos as dep, (select count(*) from o0) + (select count(*) from o1) as n1 from (
     select concat('C', c_custkey) as object, concat('N', c_nationkey) as n from customer where c_custkey % 20 not in (1, 2, 3)
     union all select concat('S', s_suppkey), concat('N', s_nationkey) from supplier) x join o1 on o1.object = x.n)),
 o3 as (select object, n2 + row_number() over (order by object) as pos from (select concat('C', c_custkey) as object, (select count(*) from o0) + (select count(*) from o1) + (select count(*) from o2) as n2
   from customer where c_custkey % 20 in (1, 2, 3))),
 ordered as (select object, 0 as level, false as in_cycle, pos from o0 union all select object, 1, false, pos from o1 union all select object, 2, false, pos from o2
   union all select object, null, true, pos from o3)"""


def ordered_objects(spark, sf):
    return graph.load_order(object_scope(spark, sf).select("object").distinct(), object_edges(spark, sf))


@query(ORDER_SQL + " select object, level, in_cycle, cast(pos * 10 as integer) as load_order from ordered")
def load_order(spark, sf):
    return ordered_objects(spark, sf)


@query(ORDER_SQL + f""", e as ({EDGES_SQL}), d as (select object,
   coalesce(string_agg(distinct dependency_object, '; ' order by dependency_object) filter (dependency_object <> object), '') as dependency_objects,
   coalesce(string_agg(distinct concat(field, ' -> ', dependency_object), '; ' order by concat(field, ' -> ', dependency_object)) filter (dependency_object <> object and dependency_scope = 'scoped'), '') as dependency_fields,
   coalesce(string_agg(distinct field, '; ' order by field) filter (dependency_object = object), '') as self_dependency_fields,
   coalesce(string_agg(distinct concat(field, ' -> ', dependency_object), '; ' order by concat(field, ' -> ', dependency_object)) filter (dependency_scope = 'external'), '') as external_dependency_fields
   from e group by 1),
 j as (select o.*, coalesce(dependency_objects, '') as dependency_objects, coalesce(dependency_fields, '') as dependency_fields, coalesce(self_dependency_fields, '') as self_dependency_fields,
   coalesce(external_dependency_fields, '') as external_dependency_fields, o.object like 'S%' as failed from ordered o left join d on d.object = o.object),
 s as (select *, concat_ws('; ', case when failed then 'DESCRIBE_FAILED' end, case when in_cycle then 'MANUAL_REVIEW_CYCLE' end, case when self_dependency_fields <> '' then 'MANUAL_REVIEW_SELF_REFERENCE' end,
   case when external_dependency_fields <> '' then 'HAS_EXTERNAL_DEPENDENCIES' end) as flags from j)
 select cast(pos * 10 as integer) as load_order, object, 'TRUE' as enabled, '' as manual_override_order, dependency_objects, dependency_fields, self_dependency_fields, external_dependency_fields,
   case when flags <> '' then flags when dependency_objects <> '' then 'ORDERED_AFTER_DEPENDENCIES' else 'ROOT' end as dependency_status,
   concat_ws(' ', case when failed then 'Object describe failed; review manually.' end,
     case when dependency_objects <> '' then concat('Depends on scoped object(s): ', dependency_objects, '.') else 'No scoped object dependencies detected.' end,
     case when self_dependency_fields <> '' then concat('Self-reference field(s): ', self_dependency_fields, '.') end,
     case when external_dependency_fields <> '' then concat('External reference field(s): ', external_dependency_fields, '.') end) as reason, '' as notes from s""")
def review_status(spark, sf):
    described = object_catalog(spark, sf).select("object").filter("object not like 'S%'")
    return graph.review_sheet(ordered_objects(spark, sf), object_edges(spark, sf), described)


# --- record graph --------------------------------------------------------------------------

LINE = "concat(l_orderkey, '-', l_linenumber)"
RECORD_EDGES = [
    ("lineitem", "true", "'Line'", LINE, "'Order'", "cast(l_orderkey as string)"),
    ("lineitem", "true", "'Line'", LINE, "'Part'", "cast(l_partkey as string)"),
    ("orders", "true", "'Order'", "cast(o_orderkey as string)", "'Customer'", "cast(o_custkey as string)"),
    ("customer", "true", "'Customer'", "cast(c_custkey as string)", "'Nation'", "cast(c_nationkey as string)"),
    ("nation", "true", "'Nation'", "cast(n_nationkey as string)", "'Region'", "cast(n_regionkey as string)"),
    ("part", "p_partkey % 50 = 1", "'Part'", "cast(p_partkey as string)", "'Part'", "cast(p_partkey + 1 as string)"),
    ("part", "p_partkey % 50 = 2", "'Part'", "cast(p_partkey as string)", "'Part'", "cast(p_partkey - 1 as string)"),
]
RECORDS = [("lineitem", "'Line'", LINE), ("orders", "'Order'", "cast(o_orderkey as string)"), ("customer", "'Customer'", "cast(c_custkey as string)"),
           ("nation", "'Nation'", "cast(n_nationkey as string)"), ("region", "'Region'", "cast(r_regionkey as string)"), ("part", "'Part'", "cast(p_partkey as string)")]


def record_edges(spark, sf):
    out = None
    for table, where, o, r, no, nr in RECORD_EDGES:
        part = read(spark, sf, table).where(where).selectExpr(f"{o} as object", f"{r} as record_id", f"{no} as needs_object", f"{nr} as needs_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""with recursive e as ({" union all ".join(f"select {o} as object, {r} as record_id, {no} as needs_object, {nr} as needs_id from {t} where {w}" for t, w, o, r, no, nr in RECORD_EDGES)}),
   seen(object, record_id) as (select 'Line', {LINE} from lineitem where l_quantity >= 49 union select e.needs_object, e.needs_id from e join seen s on s.object = e.object and s.record_id = e.record_id)
   select object, record_id from seen""")
def dependency_closure(spark, sf):
    start = read(spark, sf, "lineitem").where("l_quantity >= 49").selectExpr("'Line' as object", f"{LINE} as record_id")
    return graph.closure(start, record_edges(spark, sf))


@query(f"""with ring as (select cast(p_partkey as varchar) as p from part where p_partkey % 50 in (1, 2))
   select 'Region' as object, cast(r_regionkey as varchar) as record_id, 0 as wave, false as in_cycle from region union all select 'Nation', cast(n_nationkey as varchar), 1, false from nation
   union all select 'Customer', cast(c_custkey as varchar), 2, false from customer union all select 'Order', cast(o_orderkey as varchar), 3, false from orders
   union all select 'Part', cast(p_partkey as varchar), case when p_partkey % 50 not in (1, 2) then 0 end, p_partkey % 50 in (1, 2) from part
   union all select 'Line', {LINE}, case when not bool_or(cast(l_partkey as varchar) in (select p from ring)) then 4 end, bool_or(cast(l_partkey as varchar) in (select p from ring)) from lineitem group by 1, 2""")
def load_waves(spark, sf):
    nodes = None
    for table, o, r in RECORDS:
        part = read(spark, sf, table).selectExpr(f"{o} as object", f"{r} as record_id")
        nodes = part if nodes is None else nodes.unionByName(part)
    return graph.load_waves(nodes, record_edges(spark, sf))


# --- samples -------------------------------------------------------------------------------

COVERED_SQL = WORK_SQL + """, cf as (select distinct target_object, source_record_id, case name when 'Buyer' then 'BuyerId' when 'Keeper' then 'KeeperId' when 'Nation' then 'NationId' else name end as field from pl where name is not null),
 cs as (select distinct target_object, min(source_record_id) over (partition by target_object, field) as source_record_id from cf)"""


@query(COVERED_SQL + "select * from cs")
def coverage_sample(spark, sf):
    return sample.coverage_sample(sample.covered_fields(prepared(spark, sf).work, field_catalog(spark)))


@query(COVERED_SQL + """select cf.target_object, (select count(*) from cs where cs.target_object = cf.target_object) as records, count(distinct field) as covered_fields, count(distinct field) as diffed_fields from cf group by 1""")
def coverage_stat(spark, sf):
    covered = sample.covered_fields(prepared(spark, sf).work, field_catalog(spark))
    return sample.coverage_stat(covered, sample.coverage_sample(covered))


@query(COVERED_SQL + """select * from cs union select 'Account', v from pl join cs on cs.target_object = pl.target_object and cs.source_record_id = pl.source_record_id
   where name in ('Buyer', 'Keeper') and v is not null""")
def sample_with_parents(spark, sf):
    work = prepared(spark, sf).work
    chosen = sample.coverage_sample(sample.covered_fields(work, field_catalog(spark)))
    edges = sample.reference_edges(work, field_catalog(spark), rows(spark, ["object"], [("Sale",), ("Account",)]))
    return sample.with_dependencies(chosen, edges)


# --- link rows ------------------------------------------------------------------------------

OPP = ("case when o_orderkey % 4 = 0 then concat('N', o_orderkey) end", "case when o_orderkey % 3 <> 0 then concat('O', o_orderkey) end",
       "case when o_custkey % 5 <> 0 then concat('K', o_custkey) end")


@query(f"""with x as (select cast(o_orderkey as varchar) as source_record_id, o_custkey, coalesce({OPP[0]}, {OPP[1]}) as parent_id, {OPP[2]} as child_id, o_orderkey % 6 = 0 as held, o_orderkey % 12 = 0 as prim
     from orders where o_orderkey % 9 <> 0),
   y as (select *, held and parent_id is not null and child_id is not null as has_link from x)
   select source_record_id, case when has_link then concat('X', source_record_id) end as target_record_id,
     case when parent_id is null or child_id is null or (has_link and prim) then 'skip' when has_link then 'update' else 'create' end as operation,
     case when parent_id is null or child_id is null or (has_link and prim) then '' when has_link then 'IsPrimary=true' else concat('ContactId=', child_id, '|IsPrimary=true|OpportunityId=', parent_id) end as entries,
     case when parent_id is null or child_id is null then 'failed' when has_link and prim then 'skipped' else 'ready' end as status,
     case when parent_id is null then 'Cannot route Opportunity.ContactId because target Opportunity was not found' when child_id is null then concat('Cannot route Opportunity.ContactId because target Contact was not found for source id ', o_custkey)
       when has_link and prim then 'OpportunityContactRole already exists and is primary; nothing written' end as message from y""")
def route_to_link(spark, sf):
    o = read(spark, sf, "orders")
    entry = lambda n, e, v: f"named_struct('name', '{n}', 'ext_field', cast({e} as string), 'value', {v})"
    work = o.selectExpr(
        "'Opportunity' as target_object", "'Opportunity' as source_object", "cast(o_orderkey as string) as source_record_id", f"{OPP[0]} as target_record_id", "'data_gap' as change_type",
        f"case when o_orderkey % 9 = 0 then array({entry('Name', 'null', 'o_orderstatus')}) when o_orderkey % 2 = 0 then array({entry('ContactId', 'null', 'cast(o_custkey as string)')}) "
        f"""else array({entry('Contact', "'External_Id__c'", 'cast(o_custkey as string)')}) end as entries""")
    ids = o.where("o_orderkey % 3 <> 0").selectExpr("'Opportunity' as object", "cast(o_orderkey as string) as ext_id", "concat('O', o_orderkey) as target_id", "1 as origin").unionByName(
        read(spark, sf, "customer").where("c_custkey % 5 <> 0").selectExpr("'Contact' as object", "cast(c_custkey as string) as ext_id", "concat('K', c_custkey) as target_id", "1 as origin"))
    held = o.where("o_orderkey % 6 = 0").selectExpr(f"coalesce({OPP[0]}, {OPP[1]}) as parent_id", f"{OPP[2]} as child_id", "concat('X', o_orderkey) as link_id", "o_orderkey % 12 = 0 as is_primary")
    return lk.route_to_link(work, ids, held).select("source_record_id", "target_record_id", "operation", items_text(F.col("entries")).alias("entries"), "status", "message")


LINK_CATALOG = [
    ("OpportunityContactRole", "External_Id__c", "string", None, [], True, True, True, True),
    ("OpportunityContactRole", "Role", "string", None, [], True, True, True, False),
    ("OpportunityContactRole", "OpportunityId", "reference", "Opportunity", ["Opportunity"], True, False, True, False),
    ("OpportunityContactRole", "ContactId", "reference", "Contact", ["Contact"], True, False, True, False),
]


@query("""with x as (select cast(o_orderkey as varchar) as id, cast(o_custkey as varchar) as pk, case when o_orderkey % 25 = 0 then null else o_orderpriority end as ck, o_orderstatus as role, o_custkey from orders),
   y as (select *, case when o_custkey % 8 <> 0 then concat('O', pk) end as parent_id, case when ck <> '5-LOW' then concat('K', ck) end as child_id from x),
   z as (select *, parent_id is not null and child_id is not null as good, o_custkey % 3 = 0 as held from y),
   f as (select parent_id, child_id, min(id) as first_id, arg_min(role, id) as first_role from z where good and not held group by 1, 2),
   a as (select z.*, f.first_id, f.first_role, case when ck is null then 'failed' when not good then 'failed' when held then case when role <> 'F' then 'ready' else 'skipped' end
       when first_id = id then 'ready' when role <> first_role then 'ready' else 'skipped' end as status from z left join f on f.parent_id = z.parent_id and f.child_id = z.child_id and good and not held)
   select id as source_record_id, case when not good or ck is null then null when held then concat('X', pk, '/', ck) when first_id <> id then concat('T', first_id) end as target_record_id,
     case when status <> 'ready' then 'skip' when held or first_id <> id then 'update' else 'create' end as operation,
     case when status <> 'ready' then '' when held or first_id <> id then concat('Role=', role) else concat('ContactId=', child_id, '|External_Id__c=', id, '|OpportunityId=', parent_id, '|Role=', role) end as entries, status,
     case when ck is null then 'Cannot load OpportunityContactRole because a source parent reference is blank'
       when not good then concat('Cannot load OpportunityContactRole because related target record was not found: ', concat_ws(', ', case when parent_id is null then concat('Opportunity External_Id__c=', pk) end, case when child_id is null then concat('Contact External_Id__c=', ck) end))
       when status = 'ready' then null when held then 'No actual deltas after target lookup; nothing written' else 'No actual deltas after queued create completed; nothing written' end as message from a""")
def link_classify(spark, sf):
    o = read(spark, sf, "orders")
    entry = lambda n, e, v: f"named_struct('name', '{n}', 'ext_field', cast({e} as string), 'value', {v})"
    work = o.selectExpr(
        "'OpportunityContactRole' as target_object", "'Role' as source_object", "cast(o_orderkey as string) as source_record_id", "cast(null as string) as target_record_id", "'data_gap' as change_type",
        f"""array({entry('Opportunity', "'External_Id__c'", 'cast(o_custkey as string)')}, {entry('Contact', "'External_Id__c'", "case when o_orderkey % 25 = 0 then ' ' else o_orderpriority end")}, {entry('Role', 'null', 'o_orderstatus')}) as entries""",
        "cast(array() as array<string>) as skipped")
    c = read(spark, sf, "customer")
    ids = c.where("c_custkey % 8 <> 0").selectExpr("'Opportunity' as object", "cast(c_custkey as string) as ext_id", "concat('O', c_custkey) as target_id", "1 as origin").unionByName(
        o.where("o_orderpriority <> '5-LOW'").selectExpr("'Contact' as object", "o_orderpriority as ext_id", "concat('K', o_orderpriority) as target_id", "1 as origin").distinct())
    held = o.where("o_custkey % 3 = 0").selectExpr("concat('O', o_custkey) as parent_id", "concat('K', o_orderpriority) as child_id", "concat(o_custkey, '/', o_orderpriority) as p").distinct().select(
        "parent_id", "child_id", F.concat(F.lit("X"), "p").alias("link_id"), F.lit(False).alias("is_primary"), F.create_map(F.lit("Role"), F.lit("F")).alias("values"))
    out = lk.classify_links(work, ids, held, field_catalog(spark, LINK_CATALOG), default_rules(spark))
    return out.select("source_record_id", "target_record_id", "operation", items_text(F.col("entries")).alias("entries"), "status", "message")


# --- owners and one-table moves -----------------------------------------------------------------


def owner_records(spark, sf):
    return read(spark, sf, "events").selectExpr(
        "event_type as obj", "cast(event_id as string) as old_record_id", "map('OwnerId', cast(user_id as string), 'Boss', concat('U', user_id), 'k', props) as old_value",
        "case when event_id % 2 = 0 then map('Owner', concat('{\"External_Id__c\":\"', user_id, '\"}')) else cast(map() as map<string,string>) end as old_load_value")


OFF = "(select c_custkey from customer where c_nationkey % 3 = 0)"


@query(f"""select event_type as obj, cast(event_id as varchar) as source_record_id, 'old_value' as payload_column, 'OwnerId' as field, cast(user_id as varchar) as original_value, 'FALL' as replacement_external_id, '005F' as fallback_target_user_id from events where user_id in {OFF}
   union all select event_type, cast(event_id as varchar), 'old_value', 'Boss', concat('U', user_id), 'FALL', '005F' from events where user_id in {OFF} and event_type = 'error'
   union all select event_type, cast(event_id as varchar), 'old_load_value', 'Owner.External_Id__c', cast(user_id as varchar), 'FALL', '005F' from events where user_id in {OFF} and event_id % 2 = 0""")
def owner_audit(spark, sf):
    return replaced_owners(spark, sf).audit


def replaced_owners(spark, sf):
    users = read(spark, sf, "customer").selectExpr("concat('U', c_custkey) as id", "cast(c_custkey as string) as external_id", "c_nationkey % 3 <> 0 as is_active")
    scoped = rows(spark, ["obj", "field"], [("error", "Boss")])
    return owners.replace_owners(owner_records(spark, sf), users, "FALL", "005F", "old", scoped)


@query(f"""select cast(event_id as varchar) as old_record_id, case when user_id in {OFF} then 'FALL' else cast(user_id as varchar) end as owner,
   case when user_id in {OFF} and event_type = 'error' then 'FALL' else concat('U', user_id) end as boss,
   case when event_id % 2 = 0 then case when user_id in {OFF} then 'FALL' else cast(user_id as varchar) end end as nested from events""")
def owner_replace(spark, sf):
    r = replaced_owners(spark, sf).records
    return r.select("old_record_id", F.col("old_value")["OwnerId"].alias("owner"), F.col("old_value")["Boss"].alias("boss"),
                    F.get_json_object(F.col("old_load_value")["Owner"], "$.External_Id__c").alias("nested"))


MOVE_CATALOG = [
    ("Item", "Name", "string", None, [], True, True, True, False), ("Item", "Size", "int", None, [], True, False, True, False),
    ("Item", "Retail", "double", None, [], False, False, True, False), ("Item", "MakerId", "reference", "Maker", ["Maker", "Supplier"], True, True, True, False),
    ("Item", "RecordTypeId", "reference", "RecordType", ["RecordType"], True, True, True, False), ("Item", "Extra", "string", None, [], True, True, True, False),
]


def move_source(spark, sf):
    return read(spark, sf, "part").selectExpr(
        "cast(p_partkey as string) as Id", "p_name as Name", "p_size as Size", "p_retailprice as Retail", "case when p_partkey % 5 = 0 then '' else p_brand end as MakerId",
        "case when p_partkey % 11 = 0 then cast(null as string) else lpad(cast(p_size as string), 15, '0') end as RecordTypeId", "p_type as RecordTypeDeveloperName")


def move_types(spark, sf):
    p = read(spark, sf, "part")
    by_id = p.where("p_size % 2 = 0").selectExpr("'item' as sobjecttype", "'' as source_developername", "lpad(cast(p_size as string), 15, '0') as source_recordtypeid", "'' as target_developername", "concat('TID', p_size) as target_recordtypeid").distinct()
    by_name = p.where("p_type <> 'PROMO'").selectExpr("'' as sobjecttype", "p_type as source_developername", "'' as source_recordtypeid", "lower(p_type) as target_developername", "'' as target_recordtypeid").distinct()
    named = p.where("p_type <> 'ECONOMY'").selectExpr("lower(p_type) as developer_name", "concat('DEV', p_type) as id").distinct()
    return migrate.record_type_lookup(by_id.unionByName(by_name), "Item", named)


TYPE_SQL = """select cast(p_partkey as varchar) as record_key, case when p_partkey % 11 = 0 then null when p_size % 2 = 0 then concat('TID', p_size)
   when p_type = 'PROMO' then null when p_type = 'ECONOMY' then '__DEVNAME__:economy' else concat('DEV', p_type) end as record_type_id, p_partkey % 11 <> 0 and p_size % 2 <> 0 and p_type = 'PROMO' as bad, p_size, p_name, p_partkey from part"""


def move(spark, sf):
    return migrate.plan_move(move_source(spark, sf), field_catalog(spark, MOVE_CATALOG).filter("object = 'Item'"), move_types(spark, sf), on_unmapped="error")


@query(f"""select record_key, record_type_id, case when bad then 'precheck_error' else 'pending' end as result, case when bad then concat('No RecordType mapping for source id ''', lpad(cast(p_size as varchar), 15, '0'), '''') else '' end as errors,
   concat('Name=', p_name, '|Size=', p_size) as payload from ({TYPE_SQL})""")
def record_type_map(spark, sf):
    show = F.array_join(F.transform(F.sort_array(F.map_entries("values")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return move(spark, sf).attempts.select("record_key", "record_type_id", "result", "errors", show.alias("payload"))


@query("select cast(p_partkey as varchar) as record_key, 'MakerId' as field, p_brand as source_value, 'Maker;Supplier' as reference_to from part where p_partkey % 5 <> 0")
def omitted_lookups(spark, sf):
    return move(spark, sf).omitted.filter("field <> 'RecordTypeId'")


@query("select distinct lpad(cast(p_size as varchar), 15, '0') as record_type_id from part where p_partkey % 11 <> 0")
def record_type_ids(spark, sf):
    return migrate.record_type_ids(move_source(spark, sf))


@query(f"""select record_key, case when bad then 'precheck_error' else 'success' end as result, case when bad then '' when p_partkey % 3 = 0 then concat('I', record_key) else concat('T', record_key) end as target_id,
   case when bad then '' when p_partkey % 3 = 0 then 'False' else 'True' end as created, case when not bad then cast(floor((row_number() over (partition by bad order by record_key) - 1) / 60) as bigint) end as batch_no from ({TYPE_SQL})""")
def one_object_migration(spark, sf):
    target = read(spark, sf, "part").where("p_partkey % 3 = 0").selectExpr("'Item' as object", "concat('I', p_partkey) as record_id", "cast(p_partkey as string) as external_id")
    return migrate.apply_move(move(spark, sf), target, "Item", 60).select("record_key", "result", "target_id", "created", "batch_no")


@query(f"""select 'Item' as object, count(*) as total_source, count(*) filter (not bad) as attempted, count(*) filter (not bad) as success, 0 as failed, 2 as matched_non_lookup_fields, 1 as lookup_fields_detected from ({TYPE_SQL})""")
def migration_summary(spark, sf):
    m = move(spark, sf)
    target = read(spark, sf, "part").selectExpr("'Item' as object", "concat('I', p_partkey) as record_id", "cast(p_partkey as string) as external_id")
    return migrate.move_summary(migrate.apply_move(m, target, "Item"), m, "Item")


# --- errors ----------------------------------------------------------------------------------------

RID = "concat('a01', lpad(cast(event_id as string), 12, '0'))"
MESSAGES = f"""case event_id % 8
 when 0 then concat('[{{"message":"duplicate value found: on record ', {RID}, '","errorCode":"DUPLICATE_VALUE","fields":["A"," B "]}}]')
 when 1 then '{{"success":false,"errors":[{{"statusCode":"REQUIRED_FIELD_MISSING","message":"Required fields are missing: [X]","fields":["X"]}}]}}'
 when 2 then concat('Malformed request https://h/x. Response content: [{{''message'': ''bad value'', ''errorCode'': ''FIELD_INTEGRITY_EXCEPTION'', ''fields'': [''Z'', ''Y'']}}]')
 when 3 then 'Response content: [{{"message":"data value too large: x","errorCode":"STRING_TOO_LONG","fields":[]}}]'
 when 4 then concat('Remote end closed connection https://h/', cast(event_id as string), '   now')
 when 5 then '{{"duplicateResult":{{"errorMessage":"use one of these"}},"message":"m"}}'
 when 6 then '' else '{{"errors":["row text"]}}' end""".replace("{{", "{").replace("}}", "}")
PARSED_SQL = f"""select *, case event_id % 8 when 0 then 'DUPLICATE_VALUE' when 1 then 'REQUIRED_FIELD_MISSING' when 2 then 'FIELD_INTEGRITY_EXCEPTION' when 3 then 'STRING_TOO_LONG' when 5 then 'DUPLICATES_DETECTED' else '' end as error_code,
   case event_id % 8 when 0 then 'A; B' when 1 then 'X' when 2 then 'Z; Y' else '' end as error_fields,
   case event_id % 8 when 0 then concat('duplicate value found: on record ', {RID}) when 1 then 'Required fields are missing: [X]' when 2 then 'bad value' when 3 then 'data value too large: x'
     when 4 then 'Remote end closed connection URL now' when 5 then 'use one of these' when 6 then '' else 'row text' end as error_message,
   case when event_id % 5 = 0 then 'skip' else 'update' end as operation,
   case when event_id % 5 = 0 then 'Loader Skip' else case event_id % 8 when 0 then 'Duplicate Rule / Duplicate Value' when 1 then 'Missing Required Field' when 2 then 'Field Integrity / Reference' when 3 then 'Field Length' when 5 then 'Duplicate Rule / Duplicate Value' else 'Unclassified' end end as error_category,
   cast(user_id as varchar) as target_object, event_type as source_object, 'S' || lpad(cast(event_id as varchar), 9, '0') as source_record_id from events"""


def error_results(spark, sf):
    return errors.classified(errors.spread(read(spark, sf, "events").selectExpr(
        "cast(user_id as string) as target_object", "event_type as source_object", "concat('S', lpad(cast(event_id as string), 9, '0')) as source_record_id", "cast(event_id as string) as target_record_id",
        "case when event_id % 5 = 0 then 'skip' else 'update' end as operation", "'data_gap' as change_type", "1 as payload_field_count", "props as payload_json", f"{MESSAGES} as message", "'FALSE' as success", "event_id as seq")))


@query(f"select source_record_id, error_code, error_fields, error_message, error_category from ({PARSED_SQL})")
def error_parse(spark, sf):
    return error_results(spark, sf).select("source_record_id", "error_code", "error_fields", "error_message", "error_category")


@query(f"select operation, error_category, count(*) as n from ({PARSED_SQL}) group by 1, 2")
def error_category(spark, sf):
    return error_results(spark, sf).groupBy("operation", "error_category").agg(F.count("*").alias("n"))


@query(f"""select target_object, source_object, operation, error_category, error_code, error_fields, error_message, count(*) as row_count, min(source_record_id) as sample_source_record_id,
   arg_min(cast(event_id as varchar), source_record_id) as sample_target_record_id from ({PARSED_SQL}) group by 1, 2, 3, 4, 5, 6, 7""")
def error_summary(spark, sf):
    out = errors.error_summary(error_results(spark, sf), ["source_record_id"])
    return out.select(*errors.ERROR_KEY, "row_count", "sample_source_record_id", "sample_target_record_id")


@query(f"""select source_record_id, error_category from ({PARSED_SQL}) qualify row_number() over (partition by target_object, source_object, operation, error_category, error_code, error_fields, error_message order by source_record_id) <= 2""")
def error_examples(spark, sf):
    return errors.error_examples(error_results(spark, sf), ["source_record_id"], 2).select("source_record_id", "error_category")


@query(f"""select count(*) as occurrence_count, target_object, source_object, operation, error_category, error_code, error_fields,
   case event_id % 8 when 0 then 'duplicate value found: on record <SF_ID>' when 4 then 'Remote end closed connection URL now' else error_message end as normalized_error_message,
   min(source_record_id) as sample_source_record_id, 'k' as sample_payload_fields,
   case event_id % 8 when 4 then 'Transport or batch failure before row results came back: retry these rows.' when 0 then 'Duplicate or unique rule blocks the write: check that the matched record is the right one.'
     when 5 then 'Duplicate or unique rule blocks the write: check that the matched record is the right one.' when 1 then 'Required field is empty: a reference did not resolve or the field is not mapped.'
     when 2 then 'Integrity failure on Z; Y: bad reference, picklist value or record state.' else 'Grouped by masked message: look at the sample payload and message to classify it.' end as investigation_context
   from ({PARSED_SQL}) group by all""".replace("group by all", "group by 2, 3, 4, 5, 6, 7, 8, 11, event_id % 8"))
def failure_groups(spark, sf):
    out = errors.group_failures(error_results(spark, sf), ["source_record_id"])
    return out.select("occurrence_count", "target_object", "source_object", "operation", "error_category", "error_code", "error_fields",
                      "normalized_error_message", "sample_source_record_id", "sample_payload_fields", "investigation_context")


# --- streams ------------------------------------------------------------------------------------------


@query("select 'Event' as obj, cast(event_id as string) as record_id, f.field, case f.field when 'event_type' then event_type else cast(user_id as string) end as value from events, (values ('event_type'), ('user_id')) f(field)")
def incremental_extract(spark, sf):
    base = work_folder(spark, "stream")
    e = read(spark, sf, "events").select("event_id", "event_type", "user_id")
    for part in (0, 1):  # files arrive between two runs of the stream
        e.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        q = jobs.stream_extract(spark, f"{base}/in", e.schema, f"{base}/out", f"{base}/cp", "OLD", "Event", "old", ["event_type", "user_id", "absent"], "event_id")
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("obj", "record_id", "field", "value")


def result_stream(spark, sf, base):
    r = read(spark, sf, "events").selectExpr(
        "cast(user_id as string) as target_object", "event_type as source_record_id", "'src' as source_object", "case when event_type = 'error' then 'FALSE' else 'TRUE' end as success", "'update' as operation",
        f"{MESSAGES} as message", "event_id as seq")
    for part in (0, 1):
        r.filter(F.col("seq") % 2 == part).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


@query("select cast(user_id as varchar) as target_object, event_type as source_record_id, max(event_id) as seq from events group by 1, 2")
def running_results(spark, sf):
    base = work_folder(spark, "results")
    jobs.keep_results(result_stream(spark, sf, base), f"{base}/out", f"{base}/cp").awaitTermination()
    return jobs.stored_results(spark, f"{base}/out").select("target_object", "source_record_id", "seq")


@query(f"""select target_object, error_category, count(*) as row_count from (select target_object, case event_id % 8 when 0 then 'Duplicate Rule / Duplicate Value' when 1 then 'Missing Required Field' when 2 then 'Field Integrity / Reference'
   when 3 then 'Field Length' when 5 then 'Duplicate Rule / Duplicate Value' else 'Unclassified' end as error_category from ({PARSED_SQL}) where event_type = 'error') group by 1, 2""")
def running_errors(spark, sf):
    base = work_folder(spark, "errors")
    jobs.keep_error_counts(result_stream(spark, sf, base), f"{base}/out", f"{base}/cp").awaitTermination()
    return jobs.stored_error_counts(spark, f"{base}/out").groupBy("target_object", "error_category").agg(F.sum("row_count").alias("row_count"))


@query("""with k as (select user_id, event_type, min(event_id % 3) as b, bool_or(event_id % 40 = 0) as early, bool_or(event_id % 40 = 6) as late from events group by 1, 2)
   select cast(e.user_id as varchar) as target_object, e.event_type as source_record_id, min(event_id) as event_id from events e join k on k.user_id = e.user_id and k.event_type = e.event_type and event_id % 3 = k.b
   where not early and not (late and k.b = 2) group by 1, 2""")
def arriving_work(spark, sf):
    """Three batches that share keys; results are there ahead of the first and of the last."""
    base = work_folder(spark, "work")
    e = read(spark, sf, "events").selectExpr("cast(user_id as string) as target_object", "event_type as source_record_id", "event_id")
    for part, known in enumerate(("event_id % 40 = 0", "false", "event_id % 40 = 6")):
        e.where(known).selectExpr("target_object", "source_record_id", "'TRUE' as success").write.mode("append").parquet(f"{base}/results")
        e.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema(e.schema).parquet(f"{base}/in")
        jobs.fresh_work(arriving, jobs.result_keys(spark, f"{base}/results"), f"{base}/out", f"{base}/cp").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("target_object", "source_record_id", "event_id")
