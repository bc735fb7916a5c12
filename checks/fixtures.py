"""Two systems made out of one set of tables.

The old side keeps the records as they are and lacks every 13th.  The new side lacks every
11th, has lost the external id of every 50th, and carries changed values: lower-cased on
every 17th, padded with blanks on every 19th (not a difference), null on every 23rd.
Expressions are written once, in SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.sources.extract import unpivot_records


@dataclass(frozen=True)
class Twin:
    table: str
    key: str
    fields: dict  # name -> expression; the first is lower-cased, the second padded, the third nulled


MONEY = "cast(cast({} as decimal(18,2)) as string)"

TWINS = {
    "Orders": Twin("orders", "o_orderkey", {
        "Status": "o_orderstatus", "Priority": "o_orderpriority",
        "Price": MONEY.format("o_totalprice"), "CustomerId": "cast(o_custkey as string)"}),
    "Customer": Twin("customer", "c_custkey", {
        "Segment": "c_mktsegment", "Name": "c_name",
        "Balance": MONEY.format("c_acctbal"), "NationId": "cast(c_nationkey as string)"}),
    "Part": Twin("part", "p_partkey", {
        "Brand": "p_brand", "Name": "p_name",
        "Price": MONEY.format("p_retailprice"), "Type": "p_type"}),
}


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def columns(obj: str, side: str) -> list[str]:
    t = TWINS[obj]
    if side == "old":
        out = [f"cast({t.key} as string) as Id", "cast(null as string) as External_Id__c"]
        return out + [f"{e} as {n}" for n, e in t.fields.items()]
    out = [f"concat('N', cast({t.key} as string)) as Id",
           f"case when {t.key} % 50 = 0 then null else cast({t.key} as string) end as External_Id__c"]
    for i, (n, e) in enumerate(t.fields.items()):
        if i == 0:
            e = f"case when {t.key} % 17 = 0 then lower({e}) else {e} end"
        elif i == 1:
            e = f"case when {t.key} % 19 = 0 then concat('  ', replace({e}, ' ', '  '), ' ') else {e} end"
        elif i == 2:
            e = f"case when {t.key} % 23 = 0 then null else {e} end"
        out.append(f"{e} as {n}")
    return out


def wide(spark: SparkSession, sf: str, obj: str, side: str) -> DataFrame:
    t = TWINS[obj]
    gone = 11 if side == "new" else 13
    return read(spark, sf, t.table).where(f"{t.key} % {gone} <> 0").selectExpr(*columns(obj, side))


def long_side(spark: SparkSession, sf: str, side: str, objects=("Orders",), with_id: bool = False) -> DataFrame:
    out = None
    for obj in objects:
        names = (["Id"] if with_id else []) + list(TWINS[obj].fields)
        part = unpivot_records(wide(spark, sf, obj, side), obj, "Id", names, side.upper(), "External_Id__c")
        out = part if out is None else out.unionByName(part)
    return out


def wide_sql(obj: str, side: str) -> str:
    t = TWINS[obj]
    gone = 11 if side == "new" else 13
    return f"select {', '.join(columns(obj, side))} from {t.table} where {t.key} % {gone} <> 0"


def long_sql(side: str, objects=("Orders",), with_id: bool = False) -> str:
    parts = []
    for obj in objects:
        for n in (["Id"] if with_id else []) + list(TWINS[obj].fields):
            parts.append(f"select '{side.upper()}' as env, '{obj}' as obj, Id as record_id, '{n}' as field, "
                         f"{n} as value, External_Id__c as external_id from ({wide_sql(obj, side)})")
    return " union all ".join(parts)


# Canonical comparison form of ASCII text.
CANON = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


def parity_sql(objects=("Orders",), where_new: str = "true", where_old: str = "true",
               compared: str = "true", with_id: bool = False) -> str:
    """CTEs ``n``, ``o`` (long sides), ``rec`` (record pairs), ``fld`` (field pairs, with
    ``differs``) and ``status`` (reported records)."""
    return f"""
with n as (select obj, external_id as key, record_id, external_id, field, value from ({long_sql('new', objects, with_id)})
           where external_id is not null and ({where_new})),
o as (select obj, record_id as key, record_id, field, value from ({long_sql('old', objects, with_id)}) where ({where_old})),
nr as (select obj, key, min(record_id) as new_record_id, min(external_id) as external_id from n group by 1, 2),
orr as (select obj, key, min(record_id) as old_record_id from o group by 1, 2),
rec as (select coalesce(nr.obj, orr.obj) as obj, coalesce(nr.key, orr.key) as key,
               nr.new_record_id, orr.old_record_id, nr.external_id
        from nr full outer join orr on nr.obj = orr.obj and nr.key = orr.key),
fld as (select coalesce(n.obj, o.obj) as obj, coalesce(n.key, o.key) as key, coalesce(n.field, o.field) as field,
               n.value as new_value, o.value as old_value, n.field is not null as in_new, o.field is not null as in_old,
               {CANON.format('n.value')} is distinct from {CANON.format('o.value')} as differs
        from n full outer join o on n.obj = o.obj and n.key = o.key and n.field = o.field),
cmp as (select * from fld where {compared}),
status as (select rec.*, case when old_record_id is null then 'missing_from_old'
                              when new_record_id is null then 'missing_from_new'
                              when g.key is not null then 'data_gap' end as change_type
           from rec left join (select distinct obj, key from cmp where differs) g on g.obj = rec.obj and g.key = rec.key)
"""
