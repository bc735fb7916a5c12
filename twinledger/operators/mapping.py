"""Field and value mapping: from reported records to target payload entries.

Payloads travel as tall rows, one per source field; the scope, the catalogue and the value
maps are small tables joined to them; one shuffle on the record key gathers the result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.payload import item
from ..functions.text import BLANK_IN_LOADS, is_blank, load_text, name_candidates, strip_name, unless_blank
from ..functions.values import coerced, is_bad_number, lookup_key
from ..model import EXTERNAL_ID, RECORD_TYPE
from ..session import config, small
from .schema_diff import is_writable

VALUE_MAP = ("struct<source:struct<object:string,field:string>,"
             "target:struct<object:string,field:string>,mapping:map<string,string>>")

RECORD = ["target_object", "source_object", "source_record_id", "target_record_id", "change_type", "operation"]


def with_load_text(df: DataFrame, name: str, out: str) -> DataFrame:
    """The trimmed text of a column, null when blank, in two steps so that the trim is
    generated and evaluated once."""
    return df.withColumn(out, strip_name(name)).withColumn(out, unless_blank(F.col(out), BLANK_IN_LOADS))


def numbered(mapping: DataFrame) -> DataFrame:
    """Give every mapping row an id that survives re-computation: its content and place."""
    return mapping.withColumn("mapping_id", F.xxhash64(
        "source_object", "source_field", "target_object", "target_field", "row_no"))


def value_lookup(mapping: DataFrame) -> DataFrame:
    """The value maps as rows ``(mapping_id, key, mapped_value)``, read in the direction the
    map declares; the last of repeated keys wins."""
    m = numbered(config(mapping)).filter(F.col("value_map").isNotNull()).withColumn("m", F.from_json("value_map", VALUE_MAP))
    for side in ("source", "target"):
        for part in ("object", "field"):
            m = m.withColumn(f"_{side}_{part}", load_text(F.col(f"m.{side}.{part}")))
    ends = lambda side: F.struct(F.col(f"_{side}_object"), F.col(f"_{side}_field"))
    here = lambda side: F.struct(F.col(f"{side}_object"), F.col(f"{side}_field"))
    direct = ends("source").eqNullSafe(here("source")) & ends("target").eqNullSafe(here("target"))
    inverse = ~direct & ends("source").eqNullSafe(here("target")) & ends("target").eqNullSafe(here("source"))
    pairs = m.select("mapping_id", inverse.alias("_inv"), F.posexplode(F.map_entries("m.mapping")).alias("_pos", "e"))
    pairs = pairs.withColumn("_k", F.when(F.col("_inv"), F.col("e.value")).otherwise(F.col("e.key")))
    keyed = with_load_text(pairs, "_k", "_kt").select(
        # Never null, which Spark is told: a test for it would be pushed below the map entries with all of the above in it.
        "mapping_id", "_pos", F.coalesce(lookup_key(F.col("_k"), F.col("_kt")), F.lit("blank")).alias("key"),
        F.when(F.col("_inv"), F.col("e.key")).otherwise(F.col("e.value")).alias("mapped_value"))
    return keyed.groupBy("mapping_id", "key").agg(F.max_by("mapped_value", "_pos").alias("mapped_value"),
                                                  F.lit(True).alias("hit"))


def map_fields(tall: DataFrame, mapping: DataFrame) -> DataFrame:
    """Join ``source_object, source_field, value`` rows with their targets (several per
    field, or none) and translate values.  Unmatched values stay as they are."""
    m = numbered(mapping)
    out = tall.join(small(m.select("source_object", "source_field", "target_object", "target_field", "mapping_id", "row_no")),
                    [c for c in ("source_object", "source_field", "target_object") if c in tall.columns], "left")
    out = with_load_text(out, "value", "_key_text")
    out = out.withColumn("key", lookup_key(F.col("value"), F.col("_key_text"))).drop("_key_text").join(small(value_lookup(mapping)), ["mapping_id", "key"], "left")
    return out.withColumn("mapped_value", F.when(F.col("hit"), F.col("mapped_value")).otherwise(F.col("value"))).drop("hit", "key")


def field_targets(catalog: DataFrame) -> DataFrame:
    """Catalogue rows reachable by a payload name: fields by name, references also by
    relationship name (the last field of a repeated relationship name)."""
    kept = ["type", "relationship_name", "reference_to", "nillable", "createable", "updateable"]
    meta = F.struct(F.col("field"), *kept)
    by_field = catalog.select(F.col("object").alias("target_object"), F.lit("field").alias("_way"), F.col("field").alias("_name"), meta.alias("meta"))
    by_relation = (config(catalog).filter(F.length("relationship_name") > 0)
                   .groupBy(F.col("object").alias("target_object"), F.lit("relation").alias("_way"), F.col("relationship_name").alias("_name"))
                   .agg(F.max_by(meta, "field").alias("meta")))
    return by_field.unionByName(by_relation)


def _writable(hint: Column) -> Column:
    return F.when(hint == "create", F.col("meta.createable")).otherwise(F.col("meta.updateable"))


def shape_values(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Turn ``(target_object, target_field, mapped_value, hint)`` into a payload entry, or say
    that it cannot be written.  Adds ``entry`` (null when refused) and ``bad_number``."""
    dotted = F.col("target_field").contains(".")
    rows = rows.withColumn("_way", F.when(dotted, "relation").otherwise("field")).withColumn(
        "_name", F.when(dotted, F.substring_index("target_field", ".", 1)).otherwise(F.col("target_field")))
    rows = rows.join(small(field_targets(catalog)), ["target_object", "_way", "_name"], "left")
    # Columns, not nested expressions: each is used many times below.
    rows = with_load_text(rows, "mapped_value", "_text").withColumn("_number", F.col("_text").try_cast("double"))
    value, kind = F.col("mapped_value"), F.col("meta.type")
    ext = F.expr("substring(target_field, instr(target_field, '.') + 1)")
    blank = F.col("_text").isNull()
    usable = F.col("meta").isNotNull() & _writable(F.col("hint")) & (F.col("target_field") != "Id")
    nothing = item(F.col("meta.field"), F.lit(None))
    clear = F.when(F.col("meta.nillable"), nothing)
    relation = load_text(F.col("meta.relationship_name"))
    reference = (F.when(blank, clear)
                  .when(F.array_contains("meta.reference_to", RECORD_TYPE), None)
                  .when(relation.isNotNull(), item(relation, value, F.lit(EXTERNAL_ID)))
                  .otherwise(item(F.col("target_field"), value)))
    entry = (F.when(~usable, None)
              .when(dotted, F.when((F.length("_name") == 0) | (F.length(ext) == 0), None)
                             .when(blank, clear).otherwise(item(F.col("_name"), value, ext)))
              .when(kind == "reference", reference)
              .otherwise(item(F.col("target_field"), coerced(value, kind, F.col("_text"), F.col("_number")))))
    return rows.withColumn("entry", entry).withColumn(
        "bad_number", F.col("entry").isNotNull() & ~dotted & is_bad_number(value, F.coalesce(kind, F.lit("")), F.col("_text"), F.col("_number"))).drop(
        "_way", "_name", "meta", "_text", "_number")


def infer_entries(rows: DataFrame, catalog: DataFrame, inferred: DataFrame, key: list[str]) -> DataFrame:
    """Fallback targets for renamed object pairs.

    ``inferred`` lists ``source_object, target_object`` pairs with, optionally, a
    ``reference_field`` whose value is the key of a ``reference_object``.  Other fields try
    their candidate names in turn.  ``rows`` carries ``key`` columns that tell its rows apart,
    ``source_object, source_field, target_object, mapped_value`` and ``hint``; returns the
    key and ``inferred_entry`` for the rows that find a place.
    """
    pairs = inferred.select("source_object", "target_object", "reference_field", "reference_object").distinct()
    hit = rows.join(small(pairs), ["source_object", "target_object"])
    by_name = hit.filter(~F.coalesce(F.col("source_field") == F.col("reference_field"), F.lit(False))).select(
        *dict.fromkeys([*key, "target_object", "mapped_value", "hint"]),
        F.posexplode(name_candidates(F.col("source_field"))).alias("pos", "target_field"))
    named = (shape_values(by_name, catalog).filter(F.col("entry").isNotNull())
             .groupBy(*key).agg(F.min_by("entry", "pos").alias("inferred_entry")))
    refs = catalog.filter(F.col("type") == "reference").select(
        F.col("object").alias("target_object"), F.explode("reference_to").alias("reference_object"),
        "field", "relationship_name", "nillable", "createable", "updateable")
    blank = is_blank(F.col("mapped_value"))
    by_ref = hit.filter(F.col("source_field") == F.col("reference_field")).join(small(refs), ["target_object", "reference_object"])
    allowed = is_writable(F.col("hint"))
    # A blank key looks at the first such field only; a filled one at the first usable field.
    entry = (F.when(blank, F.when(F.col("nillable") & allowed, item(F.col("field"), F.lit(None))))
              .when(allowed & load_text(F.col("relationship_name")).isNotNull(),
                    item(F.col("relationship_name"), F.col("mapped_value"), F.lit(EXTERNAL_ID))))
    ranked = by_ref.select(*key, F.struct((~blank & entry.isNull()).alias("later"), "field").alias("o"), entry.alias("entry"))
    referenced = ranked.groupBy(*key).agg(F.min_by("entry", "o").alias("inferred_entry")).filter(F.col("inferred_entry").isNotNull())
    return named.unionByName(referenced)


def map_payload(work: DataFrame, mapping: DataFrame, catalog: DataFrame, inferred: DataFrame | None = None, keyed: bool = False) -> DataFrame:
    """Map each work row's ``payload`` (map of source field to value) to target entries.

    ``work`` carries the record columns plus ``operation`` and ``hint``.  Returns one row per
    record with ``entries`` (array of name, ext_field, value) and ``skipped`` (reasons, in
    field order).  When two source fields land on one target field the later one wins, in
    the order load-only fields, then differing fields, each by name.
    """
    tall = work.select(*RECORD, "hint", F.explode_outer("payload").alias("source_field", "value"),
                       *(["load_fields"] if "load_fields" in work.columns else []))
    late = ~F.array_contains("load_fields", F.col("source_field")) if "load_fields" in work.columns else F.lit(True)
    rows = map_fields(tall.withColumn("_late", F.coalesce(late, F.lit(True))), mapping)
    rows = rows.withColumn("_at", F.struct("_late", "source_field", F.coalesce("row_no", F.lit(0).cast("long"))))
    shaped = shape_values(rows, catalog)
    field, target = F.col("source_field"), F.col("target_field")
    if inferred is not None:
        # A row is told apart by its record, its field and the mapping it came through.
        shaped = shaped.withColumn("_target", F.coalesce(target, F.lit(""))).withColumn("_map", F.coalesce("mapping_id", F.lit(0).cast("long")))
        key = [*RECORD[:3], "source_field", "_target", "_map"]
        misses = shaped.filter(F.col("entry").isNull() & field.isNotNull() & (F.col("_target") != "Id")).select(*key, "mapped_value", "hint")
        found = infer_entries(misses, catalog, inferred, key)
        shaped = shaped.join(found.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "inferred_entry"),
                             reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]), "left")
    else:
        shaped = shaped.withColumn("inferred_entry", F.lit(None).cast(rows.sparkSession.sql(
            "select named_struct('name','','ext_field','','value','') as s").schema["s"].dataType))
    skip = (F.when(field.isNull(), None)
             .when(F.col("entry").isNotNull(), F.when(F.col("bad_number"), F.concat(field, F.lit(" -> "), target, F.lit(": not a number"))))
             .when(target.isNull(), F.when(F.col("inferred_entry").isNull(), F.concat(field, F.lit(": no metadata mapping"))))
             .when(target == "Id", F.concat(field, F.lit(": target Id is not writable")))
             .when(F.col("inferred_entry").isNotNull(), F.concat(field, F.lit(" -> "), target, F.lit(": not available; used inferred target field")))
             .otherwise(F.concat(field, F.lit(" -> "), target, F.lit(": not writable or unsupported"))))
    placed = shaped.select(*RECORD, "_at", F.coalesce("entry", "inferred_entry").alias("entry"), skip.alias("skip"))
    # Both aggregates below run on one partitioning by record: that of ``work`` if it has it (``keyed``), else this one.
    placed = placed if keyed else placed.repartition("target_object", "source_record_id")
    # Sorted by what tells most rows apart first.
    ordered = ["source_record_id", *[c for c in RECORD if c != "source_record_id"]]
    per_name = placed.groupBy(*ordered, F.col("entry.name").alias("name"), F.col("entry.ext_field").alias("ext")).agg(
        F.max(F.struct("_at", "entry")).alias("last"),
        F.collect_list(F.when(F.col("skip").isNotNull(), F.struct("_at", "skip"))).alias("skips"))
    out = per_name.groupBy(*ordered).agg(
        F.collect_list(F.when(F.col("name").isNotNull(), F.col("last.entry"))).alias("entries"),
        F.flatten(F.collect_list("skips")).alias("skips"))
    return out.select(*RECORD, F.sort_array("entries").alias("entries"),
                      F.transform(F.sort_array("skips"), lambda s: s["skip"]).alias("skipped"))


def reverse_transform(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """New-side payloads back to the old field names: one row per record and old object.
    ``mapping`` comes from ``field_mappings(.., "new_to_old", honour_ignore=False)``."""
    external, new_id, old_id = (load_text(F.col(c)) for c in ("external_id", "new_record_id", "old_record_id"))
    known = external.isNotNull() & new_id.isNotNull() & (external != new_id)
    tall = records.filter(load_text(F.col("obj")).isNotNull()).select(
        F.col("obj").alias("source_object"), new_id.alias("new_record_id"), external.alias("external_id"), "change_type",
        F.coalesce(old_id, F.when(known, external)).alias("old_record_id"),
        F.when(old_id.isNotNull() | known, "update").otherwise("create").alias("operation"),
        F.explode("new_value").alias("source_field", "value"))
    rows = map_fields(tall, mapping)
    key = ["source_object", "new_record_id", "external_id", "old_record_id", "change_type", "operation"]
    # new_record_id may be blank, so the record key is the pair of ids.
    keyed = rows.repartition("source_object", "new_record_id", "external_id", "old_record_id")
    named = keyed.groupBy(*key, "target_object", "target_field").agg(
        F.max(F.struct(F.struct("source_field", "row_no"), "mapped_value")).alias("last"),
        F.collect_set(F.when(F.col("target_object").isNull(), F.col("source_field"))).alias("unmapped"))
    per_object = named.groupBy(*key, "target_object").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("target_field") != "Id", F.struct("target_field", F.col("last.mapped_value"))))).alias("payload"),
        F.flatten(F.collect_list("unmapped")).alias("unmapped"))
    per_record = per_object.groupBy(*key).agg(
        F.collect_list(F.when(F.col("target_object").isNotNull() & (F.size("payload") > 0), F.struct("target_object", "payload"))).alias("parts"),
        F.flatten(F.collect_list("unmapped")).alias("unmapped_fields"))
    return per_record.select(
        "operation", F.col("source_object").alias("new_object"), "new_record_id", "old_record_id", "external_id",
        "change_type", F.sort_array("unmapped_fields").alias("unmapped_fields"), F.inline("parts")).withColumnRenamed("target_object", "old_object")
