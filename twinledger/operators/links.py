"""Link rows between two parents: routing a field of the parent, and classifying link deltas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.payload import item
from ..functions.text import load_text
from ..model import EXTERNAL_ID
from ..session import small
from .deltas import field_types, with_actual_deltas
from .resolve import entry_value, has_entry, resolve_ids
from .rules import apply_rules, operation_hint
from .skew import skew_join


@dataclass(frozen=True)
class Link:
    """A link object with its two parents and, for routing, the parent's field."""

    object: str
    parent_object: str
    parent_field: str
    parent_relation: str
    child_object: str
    child_field: str
    child_relation: str
    flag_field: str = "IsPrimary"


CONTACT_ROLE = Link("OpportunityContactRole", "Opportunity", "OpportunityId", "Opportunity",
                    "Contact", "ContactId", "Contact")


def reference_key(entries, relation: str, field: str):
    """External key a payload gives for a parent: the reference entry, else the plain field."""
    ref = F.get(F.filter(entries, lambda e: (e["name"] == relation) & (e["ext_field"] == EXTERNAL_ID)), F.lit(0))["value"]
    return F.coalesce(load_text(ref), load_text(entry_value(entries, field)))


def routed_key(entries, link: Link):
    return F.coalesce(load_text(entry_value(entries, link.child_field)), reference_key(entries, link.child_relation, link.child_field))


def _existing(links: DataFrame) -> DataFrame:
    """One existing link per pair, a primary one first: ``parent_id, child_id, link_id, is_primary``."""
    order = F.struct(~F.coalesce(F.col("is_primary"), F.lit(False)), F.col("link_id"))
    rest = [c for c in links.columns if c not in ("parent_id", "child_id")]
    return links.groupBy("parent_id", "child_id").agg(F.min_by(F.struct(*rest), order).alias("_l")).select("parent_id", "child_id", "_l.*")


def route_to_link(prepared: DataFrame, id_map: DataFrame, links: DataFrame, link: Link = CONTACT_ROLE) -> DataFrame:
    """Link operations for parent records whose payload names a child.

    No parent id or no child id in the target fails the row; an existing primary link is a
    successful skip; an existing other link is made primary; otherwise a link is created.
    ``id_map`` holds what the target knows, rows of this run included.
    """
    rows = prepared.filter(F.col("target_object") == link.parent_object).withColumn("_child", routed_key(F.col("entries"), link))
    rows = rows.filter(F.col("_child").isNotNull())
    rows = resolve_ids(rows, id_map, F.lit(link.parent_object), F.col("source_record_id"), "_p")
    rows = rows.withColumn("parent_id", F.coalesce(load_text(F.col("target_record_id")), F.col("_p")))
    rows = resolve_ids(rows, id_map, F.lit(link.child_object), F.col("_child"), "child_id")
    rows = skew_join(rows, _existing(links.select("parent_id", "child_id", "link_id", "is_primary")), ["parent_id", "child_id"], "left")
    blank = load_text(F.col("source_record_id")).isNull()
    no_parent, no_child = F.col("parent_id").isNull(), F.col("child_id").isNull()
    held = F.col("link_id").isNotNull()
    failed = blank | no_parent | no_child
    done = held & F.coalesce("is_primary", F.lit(False))
    flag = item(F.lit(link.flag_field), F.lit("true"))
    what = f"{link.parent_object}.{link.child_field}"
    nothing = F.expr("array()").cast("array<struct<name:string,ext_field:string,value:string>>")
    message = (F.when(blank, f"Cannot route {what} because a source id is blank")
                .when(no_parent, f"Cannot route {what} because target {link.parent_object} was not found")
                .when(no_child, F.concat(F.lit(f"Cannot route {what} because target {link.child_object} was not found for source id "), "_child"))
                .when(done, f"{link.object} already exists and is primary; nothing written"))
    return rows.select(
        F.lit(link.object).alias("target_object"), F.lit(link.parent_object).alias("source_object"), "source_record_id",
        F.when(failed, None).otherwise(F.col("link_id")).alias("target_record_id"), "change_type",
        F.when(failed | done, "skip").when(held, "update").otherwise("create").alias("operation"),
        F.when(failed | done, nothing).when(held, F.array(flag)).otherwise(F.array(
            item(F.lit(link.child_field), F.col("child_id")), flag, item(F.lit(link.parent_field), F.col("parent_id")))).alias("entries"),
        F.array(F.lit(f"{what} routed into {link.object}")).alias("skipped"),
        F.when(failed, "failed").when(done, "skipped").otherwise("ready").alias("status"), message.alias("message"))


def classify_links(prepared: DataFrame, id_map: DataFrame, links: DataFrame, catalog: DataFrame, rule_table: DataFrame,
                   link: Link = CONTACT_ROLE, new_id=None) -> DataFrame:
    """Decide create, update or skip for the deltas of a link object.

    ``links`` has ``parent_id, child_id, link_id, is_primary`` and ``values`` (map of current
    field values).  Of several creates for one pair the lowest source id creates; the others
    become updates of what they would change on it, or skips.
    """
    nothing = F.expr("array()").cast("array<struct<name:string,ext_field:string,value:string>>")
    rows = prepared.filter(F.col("target_object") == link.object)
    rows = (rows.withColumn("_pk", reference_key(F.col("entries"), link.parent_relation, link.parent_field))
                .withColumn("_ck", reference_key(F.col("entries"), link.child_relation, link.child_field)))
    rows = resolve_ids(rows, id_map, F.lit(link.parent_object), F.col("_pk"), "parent_id")
    rows = resolve_ids(rows, id_map, F.lit(link.child_object), F.col("_ck"), "child_id")
    pair = ["parent_id", "child_id"]
    rows = skew_join(rows, _existing(links), pair, "left")
    rows = rows.withColumn("_empty", F.size("entries") == 0)
    empty, blank = F.col("_empty"), F.col("_pk").isNull() | F.col("_ck").isNull()
    lost = F.col("parent_id").isNull() | F.col("child_id").isNull()
    own = F.filter("entries", lambda e: ~e["name"].isin(link.parent_relation, link.child_relation, link.parent_field, link.child_field))
    with_ids = F.concat(own, F.array(item(F.lit(link.parent_field), F.col("parent_id")), item(F.lit(link.child_field), F.col("child_id"))))
    ready = ~empty & ~blank & ~lost
    rows = rows.withColumn("entries", F.when(ready, F.sort_array(with_ids)).otherwise(nothing)).withColumn(
        "target_record_id", F.coalesce("link_id", load_text(F.col("target_record_id")))).withColumn(
        "operation", F.when(F.col("target_record_id").isNotNull(), "update").otherwise("create"))
    rows = rows.withColumn("_early", F.when(empty, "No writable mapped fields").when(
        blank, F.lit(f"Cannot load {link.object} because a source parent reference is blank")).when(lost, F.concat(
            F.lit(f"Cannot load {link.object} because related target record was not found: "),
            F.concat_ws(", ", F.when(F.col("parent_id").isNull(), F.concat(F.lit(f"{link.parent_object} {EXTERNAL_ID}="), "_pk")),
                        F.when(F.col("child_id").isNull(), F.concat(F.lit(f"{link.child_object} {EXTERNAL_ID}="), "_ck"))))))
    # The first create of a pair, found by an aggregate rather than by gathering the pair.
    first = rows.filter(F.col("_early").isNull() & (F.col("operation") == "create")).groupBy(*pair).agg(
        F.min("source_record_id").alias("_first"), F.min_by("entries", "source_record_id").alias("_first_entries"))
    rows = skew_join(rows, first, pair, "left")
    made = new_id(F.col("_first")) if new_id else F.concat(F.lit("T"), F.col("_first"))
    repeat = (F.col("operation") == "create") & F.col("_first").isNotNull() & (F.col("_first") != F.col("source_record_id"))
    rows = (rows.withColumn("_repeat", F.coalesce(repeat, F.lit(False)))
                .withColumn("target_record_id", F.when(F.col("_repeat"), made).otherwise(F.col("target_record_id")))
                .withColumn("operation", F.when(F.col("_repeat"), "update").otherwise(F.col("operation"))))
    ext_ok = catalog.filter((F.col("object") == link.object) & (F.col("field") == EXTERNAL_ID) & F.col("createable")).select(
        F.lit(link.object).alias("target_object"), F.lit(True).alias("_ext")).distinct()
    rows = rows.join(F.broadcast(ext_ok), "target_object", "left")
    add_key = (F.col("operation") == "create") & F.coalesce("_ext", F.lit(False)) & ~has_entry(F.col("entries"), EXTERNAL_ID) & F.col("_early").isNull()
    rows = rows.withColumn("entries", F.when(add_key, F.sort_array(F.concat("entries", F.array(
        item(F.lit(EXTERNAL_ID), F.col("source_record_id")))))).otherwise(F.col("entries")))
    rows = apply_rules(rows, rule_table, catalog)
    current = F.when(F.col("_repeat"), F.map_from_entries(F.transform("_first_entries", lambda e: F.struct(e["name"], e["value"])))).otherwise(F.col("values"))
    rows = rows.withColumn("_current", current)
    is_update = F.col("operation") == "update"
    rows = rows.join(small(field_types(catalog)), "target_object", "left").withColumn(
        "_types", F.coalesce("_types", F.expr("map()").cast("map<string,string>")))
    rows = with_actual_deltas(rows, F.col("_current"), F.col("_types"), is_update & F.col("_early").isNull())
    left = F.size("entries") > 0
    status = F.when(F.col("_early").isNotNull(), "failed").when(left, "ready").when(is_update, "skipped").otherwise("failed")
    message = (F.when(F.col("_early").isNotNull(), F.col("_early")).when(left, None)
                .when(F.col("_repeat"), "No actual deltas after queued create completed; nothing written")
                .when(is_update, "No actual deltas after target lookup; nothing written").otherwise("No writable mapped fields"))
    return rows.select(
        "target_object", "source_object", "source_record_id", "target_record_id", "change_type",
        F.when(status == "ready", F.col("operation")).otherwise("skip").alias("operation"), "entries", "skipped",
        status.alias("status"), message.alias("message"))
