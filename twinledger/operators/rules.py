"""Payload rules per object and operation, held as a table and applied in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import load_text
from ..model import rows
from ..session import config, small
from .resolve import has_entry

RULE_COLUMNS = ["object", "source_object", "operation", "field", "action", "if_present", "value", "reason"]

# The shipped rules.  ``operation`` is an operation, ``any``, or ``hint_create``
# (create or upsert without a target id); ``action`` is drop, default (absent and writable)
# or record_type (default to the id of the named record type).
ROUTED = "routed to the link object because the field is not writable here"
MATCH_ONLY = "used only for natural-key matching on update"
CATALOG_LOOKUP = "catalogue reference is owned by the target system, not updated from the source"
DEFAULT_RULES = [
    ("Opportunity", None, "any", "ContactId", "drop", None, None, ROUTED),
    ("Opportunity", None, "update", "Pricebook2Id", "drop", None, None, CATALOG_LOOKUP),
    ("Opportunity", None, "update", "Pricebook2", "drop", None, None, CATALOG_LOOKUP),
    ("Quote", None, "update", "Pricebook2Id", "drop", None, None, CATALOG_LOOKUP),
    ("Quote", None, "update", "Pricebook2", "drop", None, None, CATALOG_LOOKUP),
    ("OpportunityLineItem", None, "update", "PricebookEntryId", "drop", None, None, CATALOG_LOOKUP),
    ("OpportunityLineItem", None, "update", "PricebookEntry", "drop", None, None, CATALOG_LOOKUP),
    ("OpportunityLineItem", None, "update", "Product2Id", "drop", None, None, CATALOG_LOOKUP),
    ("OpportunityLineItem", None, "update", "Product2", "drop", None, None, CATALOG_LOOKUP),
    ("QuoteLineItem", None, "update", "PricebookEntryId", "drop", None, None, CATALOG_LOOKUP),
    ("QuoteLineItem", None, "update", "PricebookEntry", "drop", None, None, CATALOG_LOOKUP),
    ("QuoteLineItem", None, "update", "Product2Id", "drop", None, None, CATALOG_LOOKUP),
    ("QuoteLineItem", None, "update", "Product2", "drop", None, None, CATALOG_LOOKUP),
    ("AccountContactRelation", None, "update", "AccountId", "drop", None, None, MATCH_ONLY),
    ("AccountContactRelation", None, "update", "ContactId", "drop", None, None, MATCH_ONLY),
    ("Quote", None, "update", "OwnerId", "drop", None, None, "owner changes are rejected on update"),
    ("OpportunityContactRole", None, "update", "OpportunityId", "drop", None, None, MATCH_ONLY),
    ("OpportunityContactRole", None, "update", "ContactId", "drop", None, None, MATCH_ONLY),
    ("Account_Relationship__c", None, "update", "Main_Account__c", "drop", None, None, MATCH_ONLY),
    ("Account_Relationship__c", None, "update", "Secondary_Account__c", "drop", None, None, MATCH_ONLY),
    ("OpportunityLineItem", None, "any", "TotalPrice", "drop", "UnitPrice", None, "only one of UnitPrice and TotalPrice may be given"),
    ("Contact", None, "update", "ContactD365Id__c", "drop", None, None, "not updated, to avoid a duplicate foreign key"),
    ("Subscriptions__c", None, "any", "SL_Reason_for_Product_Change__c", "default", None, "Data Migration", "defaulted to Data Migration"),
    ("Account", "Brand__c", "hint_create", "RecordTypeId", "record_type", None, "Brand", "defaulted to record type Brand"),
]


def default_rules(spark: SparkSession) -> DataFrame:
    return rows(spark, RULE_COLUMNS, DEFAULT_RULES, ", ".join(f"{c} string" for c in RULE_COLUMNS))


def operation_hint(operation, target_record_id):
    """Which writability counts: create for a create or upsert without a target id."""
    fresh = operation.isin("create", "upsert") & load_text(target_record_id).isNull()
    return F.when(fresh, "create").otherwise("update")


def apply_rules(df: DataFrame, rule_table: DataFrame, catalog: DataFrame, record_types: DataFrame | None = None) -> DataFrame:
    """Drop and default entries; every action leaves its reason in ``skipped``.

    The rules of an object (a handful) are joined to its records as one array, so the pass
    is narrow.  ``record_types`` has ``object, developer_name, id``.
    """
    flags = catalog.select("object", "field", "createable", "updateable")
    r = config(rule_table).join(small(flags), ["object", "field"], "left")
    if record_types is not None:
        ids = record_types.select("object", F.col("developer_name").alias("value"), F.col("id").alias("_id"))
        r = r.join(small(ids), ["object", "value"], "left")
    else:
        r = r.withColumn("_id", F.lit(None).cast("string"))
    is_type = F.col("action") == "record_type"
    r = r.withColumn("value", F.when(is_type, F.col("_id")).otherwise(F.col("value")))
    packed = r.groupBy(F.col("object").alias("target_object")).agg(F.sort_array(F.collect_list(F.struct(
        "reason", "field", "source_object", "operation", "action", "if_present", "value", "createable", "updateable"))).alias("_rules"))
    out = df.join(small(packed), "target_object", "left")
    hint = operation_hint(F.col("operation"), F.col("target_record_id"))

    def applies(x):
        when = (x["operation"] == "any") | (x["operation"] == F.col("operation")) | ((x["operation"] == "hint_create") & (hint == "create"))
        scope = (x["source_object"].isNull() | (x["source_object"] == F.col("source_object")))
        partner = x["if_present"].isNull() | has_entry(F.col("entries"), x["if_present"])
        there = has_entry(F.col("entries"), x["field"])
        writable = F.coalesce(F.when(hint == "create", x["createable"]).otherwise(x["updateable"]), F.lit(False))
        act = (((x["action"] == "drop") & there) | ((x["action"] == "default") & ~there & writable) | (x["action"] == "record_type"))
        return when & scope & partner & act

    out = out.withColumn("_hits", F.filter(F.coalesce("_rules", F.expr("array()").cast(packed.schema["_rules"].dataType)), applies))
    usable = lambda x: F.coalesce(F.when(hint == "create", x["createable"]).otherwise(x["updateable"]), F.lit(False))
    drops = F.transform(F.filter("_hits", lambda x: x["action"] == "drop"), lambda x: x["field"])
    adds = F.filter("_hits", lambda x: (x["action"] != "drop") & usable(x) & x["value"].isNotNull() & ~has_entry(F.col("entries"), x["field"]))
    note = lambda x: F.concat(x["field"], F.lit(": "), F.when(
        (x["action"] == "record_type") & ~usable(x), F.lit("record type could not be set because the field is not createable")).when(
        (x["action"] == "record_type") & x["value"].isNull(), F.lit("record type was not found")).otherwise(x["reason"]))
    entries = F.concat(F.filter("entries", lambda e: ~F.array_contains(drops, e["name"])),
                       F.transform(adds, lambda x: F.struct(x["field"].alias("name"), F.lit(None).cast("string").alias("ext_field"), x["value"].alias("value"))))
    out = out.withColumn("_entries", F.sort_array(entries)).withColumn(
        "skipped", F.concat("skipped", F.transform("_hits", note)))
    return out.drop("entries", "_hits", "_rules").withColumnRenamed("_entries", "entries").select(*df.columns)
