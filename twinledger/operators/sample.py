"""Samples that cover every field, and the records they depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import load_text
from ..model import EXTERNAL_ID, RECORD_KEY
from ..session import small
from .graph import closure
from .resolve import best_ids, reference_fields


def covered_fields(prepared: DataFrame, catalog: DataFrame) -> DataFrame:
    """Target fields each record writes; a reference counts as its field."""
    tall = prepared.select(*RECORD_KEY, F.explode("entries").alias("e")).select(
        *RECORD_KEY, F.col("e.name").alias("name"), F.col("e.ext_field").isNotNull().alias("_ref"))
    out = tall.join(small(reference_fields(catalog).select("target_object", "name", F.col("field").alias("_field"))),
                    ["target_object", "name"], "left")
    return out.select(*RECORD_KEY, F.when(F.col("_ref"), F.coalesce("_field", "name")).otherwise(F.col("name")).alias("field")).distinct()


def coverage_sample(covered: DataFrame, order: str = "source_record_id") -> DataFrame:
    """The records that are first to bring some field: taking records in order and keeping
    one whenever it shows an unseen field picks exactly these."""
    first = covered.groupBy("target_object", "field").agg(F.min_by("source_record_id", F.struct(order, "source_record_id")).alias("source_record_id"))
    return first.select(*RECORD_KEY).distinct()


def coverage_stat(covered: DataFrame, sample: DataFrame) -> DataFrame:
    """Per object: records chosen, fields they cover, fields seen at all."""
    chosen = covered.join(small(sample.withColumn("_in", F.lit(True))), RECORD_KEY, "left")
    per_field = chosen.groupBy("target_object", "field").agg(F.max(F.coalesce("_in", F.lit(False))).alias("_in"))
    fields = per_field.groupBy("target_object").agg(F.count_if("_in").alias("covered_fields"), F.count("*").alias("diffed_fields"))
    size = sample.groupBy("target_object").agg(F.count("*").alias("records"))
    return fields.join(size, "target_object", "left").select("target_object", F.coalesce("records", F.lit(0)).alias("records"), "covered_fields", "diffed_fields")


def reference_edges(prepared: DataFrame, catalog: DataFrame, load_objects: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Record-level dependencies ``object, record_id -> needs_object, needs_id``: one per
    object a reference may point to, only objects being loaded, and only keys that the
    target does not hold yet."""
    tall = prepared.select(*RECORD_KEY, F.explode("entries").alias("e")).filter(F.col("e.ext_field") == EXTERNAL_ID)
    refs = tall.select(*RECORD_KEY, F.col("e.name").alias("name"), load_text(F.col("e.value")).alias("needs_id")).dropna(subset=["needs_id"])
    out = (refs.join(small(reference_fields(catalog).select("target_object", "name", "reference_to")), ["target_object", "name"])
               .select(F.col("target_object").alias("object"), F.col("source_record_id").alias("record_id"),
                       F.explode("reference_to").alias("needs_object"), "needs_id")
               .join(small(load_objects.select(F.col("object").alias("needs_object")).distinct()), "needs_object", "left_semi").distinct())
    if id_map is not None:
        held = best_ids(id_map).select(F.col("object").alias("needs_object"), F.col("ext_id").alias("needs_id"))
        out = out.join(held, ["needs_object", "needs_id"], "left_anti")
    return out.select("object", "record_id", "needs_object", "needs_id")


def with_dependencies(sample: DataFrame, edges: DataFrame) -> DataFrame:
    """A sample and everything it needs, directly or not."""
    start = sample.select(F.col("target_object").alias("object"), F.col("source_record_id").alias("record_id"))
    return closure(start, edges).select(F.col("object").alias("target_object"), F.col("record_id").alias("source_record_id"))
