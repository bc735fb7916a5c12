"""Replacing inactive owners inside reported payloads before they are loaded."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.text import load_text
from ..model import EXTERNAL_ID
from ..operators.skew import skew_join
from ..session import small

# Owner fields that every object may carry, flat and nested.
OWNER_FIELDS = ("OwnerId", "Owner.External_Id__c", "User.External_Id__c", "UserId")
OWNER_RELATIONS = ("Owner", "User")


@dataclass(frozen=True)
class Replaced:
    records: DataFrame
    audit: DataFrame


def inactive_keys(users: DataFrame) -> DataFrame:
    """Ids and external ids of inactive users (``id, external_id, is_active``)."""
    off = users.filter(~F.col("is_active"))
    return (off.select(load_text(F.col("id")).alias("owner_key"))
               .unionByName(off.select(load_text(F.col("external_id")).alias("owner_key"))).dropna().distinct())


def owner_fields(mapping: DataFrame, target_fields=("OwnerId", "Owner.External_Id__c")) -> DataFrame:
    """Source fields that the scope maps onto an owner field: ``obj, field``."""
    return mapping.filter(F.col("target_field").isin(*target_fields)).select(
        F.col("source_object").alias("obj"), F.col("source_field").alias("field")).distinct()


def replace_owners(records: DataFrame, users: DataFrame, fallback_key: str, fallback_id: str, side: str = "old",
                   scoped: DataFrame | None = None) -> Replaced:
    """Put the fallback user's key where a payload names an inactive owner.

    The owner values of a record become one array; all of them meet the inactive keys in one join,
    and only hits travel back to the records.  The audit has one row per replaced value.
    """
    spec: dict[str, list[str] | None] = {f: None for f in OWNER_FIELDS}
    if scoped is not None:
        # Bounded by the number of distinct owner field names in the scope.
        for row in scoped.groupBy("field").agg(F.collect_set("obj").alias("objs")).collect():
            if row["field"] not in spec:
                spec[row["field"]] = row["objs"]
    keys, record_id = inactive_keys(users), f"{side}_record_id"
    columns = (f"{side}_value", f"{side}_load_value")
    named = []
    for column in columns:
        for field, objs in sorted(spec.items()) + [(r, None) for r in OWNER_RELATIONS]:
            nested = field in OWNER_RELATIONS
            raw = F.element_at(F.col(column), field)
            value = load_text(F.get_json_object(raw, f"$.{EXTERNAL_ID}") if nested else raw)
            if objs is not None:
                value = F.when(F.col("obj").isin(*objs), value)
            named.append(F.when(value.isNotNull(), F.struct(F.lit(column).alias("column"), F.lit(field).alias("field"),
                                                            F.lit(nested).alias("nested"), value.alias("owner_key"))))
    owners = records.select("obj", record_id, *columns).select("obj", record_id, F.inline(F.array_compact(F.array(*named))))
    hits = skew_join(owners, small(keys), ["owner_key"], "inner")
    per_record = hits.groupBy("obj", record_id).agg(F.collect_set(F.struct("column", "field", "nested", "owner_key")).alias("_hits"))
    per_record = per_record.select(F.col("obj").alias("_o"), F.col(record_id).alias("_r"), "_hits")
    out = records.join(per_record, F.col("obj").eqNullSafe(F.col("_o")) & F.col(record_id).eqNullSafe(F.col("_r")), "left")

    def replaced(column: str):
        def value(k, v):
            # Rows that share a record id share the hits; each looks for its own values among them.
            mine = F.filter("_hits", lambda h: (h["column"] == column) & (h["field"] == k) & (h["owner_key"] == load_text(
                F.when(h["nested"], F.get_json_object(v, f"$.{EXTERNAL_ID}")).otherwise(v))))
            nested = F.concat(F.lit(f'{{"{EXTERNAL_ID}":"'), F.lit(fallback_key), F.lit('"}'))
            return F.when(F.size(mine) == 0, v).when(F.get(mine, F.lit(0))["nested"], nested).otherwise(F.lit(fallback_key))
        return F.when(F.col("_hits").isNull(), F.col(column)).otherwise(F.transform_values(F.col(column), value))
    name = F.when(F.col("nested"), F.concat("field", F.lit(f".{EXTERNAL_ID}"))).otherwise(F.col("field"))
    audit = hits.select("obj", F.coalesce(load_text(F.col(record_id)), F.lit("")).alias("source_record_id"), F.col("column").alias("payload_column"),
                        name.alias("field"), F.col("owner_key").alias("original_value"), F.lit(fallback_key).alias("replacement_external_id"),
                        F.lit(fallback_id).alias("fallback_target_user_id"))
    return Replaced(out.withColumns({c: replaced(c) for c in columns}).select(*records.columns), audit)
