"""Record and field parity, exclusions, audits, wide and schema comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger.functions import payload
from twinledger.model import rows
from twinledger.operators import audit, parity, schema_diff, wide as wide_compare_op
from twinledger.session import work_folder
from twinledger.sources import extract as ex, store

from .fixtures import CANON, long_side, long_sql, parity_sql, read, wide, wide_sql
from .registry import query

PAIR = ("Orders", "Customer")
GLOBS = ["*Id", "Customer.B*", "Orders.[XY]*"]
GLOB_SQL = "(field like '%Id' or (obj = 'Customer' and field like 'B%'))"


def both(spark, sf, objects=PAIR, **options):
    with_id = options.pop("with_id", False)
    return parity.record_parity(long_side(spark, sf, "new", objects, with_id), long_side(spark, sf, "old", objects, with_id), **options)


def exclusions(spark):
    return rows(spark, ["obj", "field", "reason"], [
        ("Customer", None, "whole object"), ("Orders", "Priority", "first"), ("Orders", "Priority", "noise"), ("", "Price", "ignored")])


@query(parity_sql(PAIR) + """select s.obj, s.new_record_id, s.old_record_id, s.external_id, s.change_type, coalesce(c.n, 0) as differing
   from status s left join (select obj, key, count(*) filter (differs) as n from fld group by 1, 2) c on c.obj = s.obj and c.key = s.key
   where s.change_type is not null""")
def record_parity(spark, sf):
    # A field of a missing record that is null is no difference between the sides.
    shown = F.size(F.filter("items", lambda x: ~x["load_only"] & x["differs"])).cast("long")
    return both(spark, sf).paired.select("obj", "new_record_id", "old_record_id", "external_id", "change_type", shown.alias("differing"))


FIELD_SQL = """select f.obj, f.field, coalesce(s.new_record_id, '') as new_record_id, coalesce(s.old_record_id, '') as old_record_id,
     coalesce(s.external_id, '') as external_id, coalesce(f.new_value, '') as new_value, coalesce(f.old_value, '') as old_value, s.change_type
   from cmp f join status s on s.obj = f.obj and s.key = f.key
   where s.change_type is not null and case when s.change_type = 'data_gap' then f.differs else f.new_value is not null or f.old_value is not null end"""


@query(parity_sql(PAIR) + FIELD_SQL)
def field_parity(spark, sf):
    return both(spark, sf).fields


@query(f"select obj, 'new' as side, count(*) as row_count, count(distinct record_id) as record_count from ({long_sql('new', PAIR)}) where external_id is null group by 1")
def unkeyed_rows(spark, sf):
    return both(spark, sf).unkeyed


@query(parity_sql(PAIR, "obj <> 'Customer' and field <> 'Priority'", "obj <> 'Customer' and field <> 'Priority'") + FIELD_SQL)
def hard_exclusions(spark, sf):
    return both(spark, sf, exclusions=exclusions(spark)).fields


@query(parity_sql(PAIR, compared=f"not {GLOB_SQL}", with_id=True) + FIELD_SQL)
def glob_exclusions(spark, sf):
    return both(spark, sf, comparison_excluded=GLOBS, with_id=True).fields


GLOB_REASON = "case when field like '%Id' then '*Id' else 'Customer.B*' end"


@query(f"""select env, obj, field, reason, count(*) as excluded_row_count from (
   select env, obj, field, case when obj = 'Customer' then 'whole object' when obj = 'Orders' and field = 'Priority' then 'noise'
     when {GLOB_SQL} then concat('Comparison-only field exclusion from function parameter: ', {GLOB_REASON}) end as reason
   from ({long_sql('new', PAIR, True)} union all {long_sql('old', PAIR, True)})) where reason is not null group by 1, 2, 3, 4""")
def exclusion_audit(spark, sf):
    return both(spark, sf, exclusions=exclusions(spark), comparison_excluded=GLOBS, with_id=True).excluded


@query(parity_sql(PAIR, compared=f"not {GLOB_SQL}", with_id=True) + f"""
   select s.obj, s.key, s.change_type, side, field, v as value from status s join (
     select obj, key, field, 'new' as side, new_value as v from fld where {GLOB_SQL} and in_new
     union all select obj, key, field, 'old', old_value from fld where {GLOB_SQL} and in_old) l on l.obj = s.obj and l.key = s.key
   where s.change_type is not null""")
def load_only_payload(spark, sf):
    p = both(spark, sf, comparison_excluded=GLOBS, with_id=True)
    recs = p.records.withColumn("key", F.coalesce("external_id", "old_record_id"))
    out = None
    for side in ("new", "old"):
        part = recs.select("obj", "key", "change_type", F.lit(side).alias("side"), F.explode(f"{side}_load_value").alias("field", "value"))
        out = part if out is None else out.unionByName(part)
    return out


@query(parity_sql(("Orders",)) + """, p as (select s.obj, s.key, s.change_type, f.field, f.new_value, f.old_value, f.in_new, f.in_old, f.differs
     from status s join fld f on f.obj = s.obj and f.key = s.key where s.change_type is not null)
   select key, change_type,
     coalesce(string_agg(concat(field, '=', coalesce(new_value, '-')), '|' order by field) filter (case when change_type = 'data_gap' then differs else in_new end), '') as new_value,
     coalesce(string_agg(concat(field, '=', coalesce(old_value, '-')), '|' order by field) filter (case when change_type = 'data_gap' then differs else in_old end), '') as old_value,
     string_agg(concat(field, ':', coalesce(old_value, '-'), '>', coalesce(new_value, '-')), '|' order by field) filter (change_type <> 'data_gap' or differs) as field_diff
   from p group by 1, 2""")
def record_payloads(spark, sf):
    r = both(spark, sf, ("Orders",)).records
    show = lambda c: F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("-")))), "|")
    diff = F.array_join(F.sort_array(F.transform(F.map_entries("field_diff"), lambda e: F.concat(
        e["key"], F.lit(":"), F.coalesce(e["value"]["from"], F.lit("-")), F.lit(">"), F.coalesce(e["value"]["to"], F.lit("-"))))), "|")
    return r.select(F.coalesce("external_id", "old_record_id").alias("key"), "change_type", show("new_value").alias("new_value"),
                    show("old_value").alias("old_value"), diff.alias("field_diff"))


@query(parity_sql(PAIR) + "select obj, change_type, count(*) as row_count from status where change_type is not null group by 1, 2")
def diff_counts(spark, sf):
    return audit.record_counts(both(spark, sf).records)


COUNTED = f", fd as ({FIELD_SQL}) select obj, field, change_type, count(*) as row_count from fd group by 1, 2, 3"


@query(parity_sql(PAIR) + COUNTED)
def field_counts(spark, sf):
    return audit.field_counts(both(spark, sf).fields)


def scope_lists(spark):
    objects = rows(spark, ["object"], [("Orders",), ("1Part",)])
    pairs = rows(spark, ["object", "field"], [("Orders", "Status"), ("Orders", "Price"), ("Customer", "Name")])
    return objects, pairs


@query(parity_sql(PAIR) + "select obj, count(*) as row_count from status where change_type is not null and obj <> 'Orders' group by 1")
def invalid_objects(spark, sf):
    return audit.invalid_objects(audit.record_counts(both(spark, sf).records), scope_lists(spark)[0])


@query(parity_sql(PAIR) + f", fd as ({FIELD_SQL}) select obj, field, count(*) as row_count from fd where not (obj = 'Orders' and field in ('Status', 'Price')) group by 1, 2")
def invalid_pairs(spark, sf):
    return audit.invalid_pairs(audit.field_counts(both(spark, sf).fields), *scope_lists(spark))


def audited(spark, sf):
    """The diff as it is stored: written once, with its counts, and audited from there."""
    path = work_folder(spark, "audited")
    new, old = (ex.with_bucket(long_side(spark, sf, s, PAIR), s) for s in ("new", "old"))
    store.write_paired(parity.record_parity(new, old).paired, new.unionByName(old), path, "a")
    return path


@query()
def audit_summary(spark, sf):
    path = audited(spark, sf)
    paired = store.read_paired(spark, path)
    counts, per_field = audit.record_counts(parity.records(paired)), audit.field_counts(parity.fields(paired))
    objects, pairs = scope_lists(spark)
    return audit.summary(counts, audit.invalid_objects(counts, objects), per_field, audit.invalid_pairs(per_field, objects, pairs), store.manifest_rows(spark, path))


@query(parity_sql(PAIR) + """select obj, change_type, coalesce(new_record_id, '') as new_record_id, coalesce(old_record_id, '') as old_record_id from status where change_type is not null
   qualify row_number() over (partition by obj, change_type order by md5(concat_ws('|', '8451', coalesce(new_record_id, ''), coalesce(old_record_id, '')))) <= 5""")
def group_sample(spark, sf):
    r = both(spark, sf).records
    return audit.record_sample(r, 5).select("obj", "change_type", "new_record_id", "old_record_id")


@query(parity_sql(PAIR) + f""", fd as ({FIELD_SQL}) select obj, field, new_record_id, old_record_id, external_id, new_value, old_value, change_type from (
   select *, row_number() over (partition by obj, field, change_type order by old_record_id, new_record_id) as r from fd) where r <= 5""")
def first_k(spark, sf):
    return audit.field_sample(both(spark, sf).fields, 5)


@query(parity_sql(PAIR) + FIELD_SQL)
def diff_resume(spark, sf):
    """Store half of the buckets, resume for the rest, read all parts back."""
    path = work_folder(spark, "diff")
    new = ex.with_bucket(long_side(spark, sf, "new", PAIR), "new")
    old = ex.with_bucket(long_side(spark, sf, "old", PAIR), "old")
    first = F.col("join_bucket") < "016"
    part = parity.record_parity(new.filter(first), old.filter(first))
    store.write_paired(part.paired, new.filter(first).unionByName(old.filter(first)), path, "settings-1")
    done = store.done_buckets(spark, path, "settings-1")
    new_rest, old_rest = store.skip_done(new, done), store.skip_done(old, done)
    rest = parity.record_parity(new_rest, old_rest)
    store.write_paired(rest.paired, new_rest.unionByName(old_rest), path, "settings-1")
    return parity.fields(store.read_paired(spark, path))


@query(parity_sql(PAIR) + """select f.obj, s.key, f.field, f.old_value as value, s.change_type from fld f join status s on s.obj = f.obj and s.key = f.key
   where s.change_type in ('data_gap', 'missing_from_new') and s.obj = 'Customer' and case when s.change_type = 'data_gap' then f.differs else f.in_old end""")
def diff_part_reader(spark, sf):
    path = work_folder(spark, "records")
    store.write_record_parts(both(spark, sf).records, path)
    back = store.read_record_parts(spark, path, objects=["Customer"], change_types=["data_gap", "missing_from_new"])
    return back.select("obj", F.col("old_record_id").alias("key"), F.explode("old_value").alias("field", "value"), "change_type")


@query(f"""with l as (select lower(trim(coalesce(External_Id__c, ''))) as uid0, * from ({wide_sql('Customer', 'new')}) where External_Id__c is not null),
   r as (select *, trim(Id) as uid from ({wide_sql('Customer', 'old')})),
   m as (select l.uid0 as uid, l.Id as source_id, r.Id as target_id, l.Segment as s1, r.Segment as t1, l.Name as s2, r.Name as t2, l.Balance as s3, r.Balance as t3,
         l.NationId as s4, r.NationId as t4 from l join r on l.uid0 = r.uid)
   select uid, source_id, target_id, 'Segment' as field, s1 as source_value, t1 as target_value, 'CHANGED' as change_type from m where s1 is distinct from t1
   union all select uid, source_id, target_id, 'Name', s2, t2, 'CHANGED' from m where s2 is distinct from t2
   union all select uid, source_id, target_id, 'Balance', s3, t3, 'CHANGED' from m where s3 is distinct from t3
   union all select uid, source_id, target_id, 'NationId', s4, t4, 'CHANGED' from m where s4 is distinct from t4
   union all select External_Id__c, Id, null, null, null, null, 'SOURCE_ONLY' from ({wide_sql('Customer', 'new')}) n
     where External_Id__c is null or External_Id__c not in (select uid from r)
   union all select uid, null, Id, null, null, null, 'TARGET_ONLY' from r where uid not in (select uid0 from l)""")
def wide_compare(spark, sf):
    old = wide(spark, sf, "Customer", "old").drop("External_Id__c").withColumn("Uid", F.col("Id"))
    return wide_compare_op.compare_wide(wide(spark, sf, "Customer", "new"), old, "External_Id__c", "Uid")


SIDE = {"l": ("p_partkey % 7 <> 0", "p_type"),
        "r": ("p_partkey % 5 <> 0", "case when p_partkey % 3 = 0 then concat(p_type, '2') when p_partkey % 4 = 0 then null else p_type end")}


def side_catalog(spark, sf, side):
    keep, kind = SIDE[side]
    return read(spark, sf, "part").where(keep).selectExpr("p_brand as object", "concat(p_name, cast(p_partkey as string)) as Field", f"{kind} as Type",
                                                          "p_name as Label", "p_size % 2 = 0 as Queryable")


SCHEMA_SQL = " ,".join(f"{s} as (select p_brand as object, concat(p_name, cast(p_partkey as varchar)) as field, {k} as type, p_name as label, p_size % 2 = 0 as queryable from part where {w})"
                       for s, (w, k) in SIDE.items())


@query(f"""with {SCHEMA_SQL} select coalesce(l.object, r.object) as object, coalesce(l.field, r.field) as field, l.field is not null as in_left, r.field is not null as in_right,
   l.type as type_left, r.type as type_right, l.label as label_left, r.label as label_right, l.queryable as queryable_left, r.queryable as queryable_right,
   cast(null as boolean) as creatable_left, cast(null as boolean) as creatable_right, cast(null as boolean) as updateable_left, cast(null as boolean) as updateable_right,
   case when r.field is null then 'ONLY_IN_LEFT' when l.field is null then 'ONLY_IN_RIGHT' when l.type <> r.type then 'TYPE_MISMATCH' else 'SAME' end as status
   from l full outer join r on l.object = r.object and l.field = r.field""")
def schema_compare(spark, sf):
    return schema_diff.compare_schemas(side_catalog(spark, sf, "l"), side_catalog(spark, sf, "r"), ["object"])


@query(f"""with {SCHEMA_SQL} select status, count(*) as row_count from (select case when r.field is null then 'ONLY_IN_LEFT' when l.field is null then 'ONLY_IN_RIGHT'
   when l.type <> r.type then 'TYPE_MISMATCH' else 'SAME' end as status from l full outer join r on l.object = r.object and l.field = r.field) group by 1""")
def schema_status_counts(spark, sf):
    return schema_diff.status_counts(schema_diff.compare_schemas(side_catalog(spark, sf, "l"), side_catalog(spark, sf, "r"), ["object"]))


@query(f"""with {SCHEMA_SQL}, rr as (select case when object = 'Brand#7' then 'Renamed' else object end as object, field from r where object <> 'Brand#9'),
   p as (select distinct object as source_object, case when object = 'Brand#7' then 'Renamed' else object end as target_object from l)
   select source_object, target_object, null as source_field, null as target_field, 'target_object_not_found' as comparison_result from p where target_object not in (select object from rr)
   union all select p.source_object, p.target_object, l.field, null, 'missing_in_target' from p join l on l.object = p.source_object
     where p.target_object in (select object from rr) and not exists (select 1 from rr where rr.object = p.target_object and rr.field = l.field)
   union all select p.source_object, p.target_object, null, rr.field, 'missing_in_source' from p join rr on rr.object = p.target_object
     where not exists (select 1 from l where l.object = p.source_object and l.field = rr.field)""")
def field_set_diff(spark, sf):
    low = lambda df: df.select("object", F.col("Field").alias("field"))
    right = low(side_catalog(spark, sf, "r")).filter("object <> 'Brand#9'").withColumn(
        "object", F.when(F.col("object") == "Brand#7", "Renamed").otherwise(F.col("object")))
    return schema_diff.field_set_diff(low(side_catalog(spark, sf, "l")), right, rows(spark, ["source_object", "target_object"], [("Brand#7", "Renamed")]))


SELECT_SIDE = {
    "s": ("p_partkey % 7 <> 0", "case when p_size % 10 = 0 then 'reference' else p_type end"),
    "t": ("p_partkey % 5 <> 0", "case when p_size % 10 = 0 then 'reference' when p_partkey % 9 = 0 then 'text' else p_type end")}


def _field_name(side):
    return "case when p_partkey % 50 = 1 then 'Id' when p_partkey % 50 = 2 then 'RecordTypeId' when p_partkey % 50 = 3 then 'IsDeleted' else concat(p_name, cast(p_partkey as string)) end"


def _select_sql(side):
    keep, kind = SELECT_SIDE[side]
    return (f"select object, field, min(type) as type, bool_and(q) as q, bool_or(c) as c from (select concat('O', cast(p_partkey // 50 as string)) as object, {_field_name(side)} as field, {kind} as type, p_size % 6 <> 0 as q, p_size % 4 <> 0 as c "
            f"from part where {keep}) group by 1, 2")


@query(f"""with s as ({_select_sql('s')}), t as ({_select_sql('t')}),
   b as (select coalesce(s.object, t.object) as object, coalesce(s.field, t.field) as field, s.field is not null as in_source, t.field is not null as in_target,
      s.type as st, t.type as tt, coalesce(s.q, true) as q, coalesce(t.type <> 'reference' and t.c and t.field not in ('Id', 'RecordTypeId', 'IsDeleted'), false) as safe,
      coalesce(s.type = 'reference', false) or coalesce(t.type = 'reference', false) as ref, s.type is not distinct from t.type as same
      from s full outer join t on s.object = t.object and s.field = t.field),
   c as (select *, case when not in_source or not in_target then 'excluded' when ref and q and same then 'reference' when not ref and q and safe and same then 'write' else 'excluded' end as category from b
      where field not in ('Id', 'RecordTypeId'))
   select object, field, category, in_source, in_target, coalesce(st, '') as source_type, coalesce(tt, '') as target_type,
      case when not in_source or not in_target then 'missing_in_one_org' when category <> 'excluded' then null when field = 'IsDeleted' then 'reserved_field'
        when ref then 'reference_field_logged_only' when not q then 'not_queryable_in_source' when not safe then 'not_writable_in_target' when not same then 'type_mismatch' else 'excluded_other' end as reason from c
   union all select o.object, 'Id', 'id', s.field is not null, t.field is not null, coalesce(s.type, ''), coalesce(t.type, ''), null
      from (select distinct object from s) o left join s on s.object = o.object and s.field = 'Id' left join t on t.object = o.object and t.field = 'Id'
   union all select s.object, 'RecordTypeId', 'recordtype', true, t.field is not null, s.type, coalesce(t.type, ''), null
      from s left join t on t.object = s.object and t.field = 'RecordTypeId' where s.field = 'RecordTypeId'""")
def field_select(spark, sf):
    from twinledger.model import catalog

    def side(name):
        keep, kind = SELECT_SIDE[name]
        df = read(spark, sf, "part").where(keep).selectExpr(
            "concat('O', cast(p_partkey div 50 as string)) as object", f"{_field_name(name)} as field", f"{kind} as type",
            "p_size % 6 <> 0 as queryable", "p_size % 4 <> 0 as createable")
        one = df.groupBy("object", "field").agg(F.min("type").alias("type"), F.bool_and("queryable").alias("queryable"), F.bool_or("createable").alias("createable"))
        return catalog(one.withColumn("updateable", F.lit(False)))

    return schema_diff.select_fields(side("s"), side("t"))
