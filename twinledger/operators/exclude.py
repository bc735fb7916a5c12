"""Hard exclusions (rows leave before comparison) and comparison-only exclusions (fields
stay out of the comparison but remain loadable), each with counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import first_glob, strip
from ..session import checkpointed, small
from .patterns import FEW, first_specs, listed, with_spec

GLOB_REASON = "Comparison-only field exclusion from function parameter: "


def exclusion_rules(exclusions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Object rules (blank field) and field rules; a later row replaces an earlier one."""
    order = F.col("row_no") if "row_no" in exclusions.columns else F.lit(0)
    clean = exclusions.select(*[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in ("obj", "field", "reason")],
                              order.alias("row_no")).filter(F.col("obj") != "")
    objects = clean.filter(F.col("field") == "").groupBy("obj").agg(
        F.max_by("reason", F.struct("row_no", "reason")).alias("_object_reason"))
    fields = clean.filter(F.col("field") != "").groupBy("obj", "field").agg(
        F.max_by("reason", F.struct("row_no", "reason")).alias("_field_reason"))
    return objects, fields


def with_reason(long_df: DataFrame, exclusions: DataFrame | None) -> DataFrame:
    """Add ``reason``: the object reason before the field reason, null when kept."""
    if exclusions is None:
        return long_df.withColumn("reason", F.lit(None).cast("string"))
    objects, fields = exclusion_rules(exclusions)
    out = long_df.join(small(objects), "obj", "left").join(small(fields), ["obj", "field"], "left")
    return out.withColumn("reason", F.coalesce("_object_reason", "_field_reason")).drop("_object_reason", "_field_reason")


def hard_excluded(long_df: DataFrame, exclusions: DataFrame | None) -> DataFrame:
    """Rows that survive the exclusion table."""
    if exclusions is None:
        return long_df
    objects, fields = exclusion_rules(exclusions)
    return (long_df.join(small(objects), "obj", "left_anti")
                   .join(small(fields), ["obj", "field"], "left_anti"))


def comparison_spec(specs):
    """Expression over obj and field: the matching comparison-only spec, or null."""
    return first_glob(F.col("obj"), F.col("field"), specs)


def spec_table(names: DataFrame, specs) -> DataFrame | None:
    """For many specs, or specs that are a table (``place, spec``), the first that matches each of ``names`` (``obj, field``); for a few None,
    as :func:`comparison_spec` does without a table."""
    if not isinstance(specs, DataFrame):
        if len(specs or ()) <= FEW:
            return None
        specs = listed(names.sparkSession, specs)
    return checkpointed(first_specs(names, specs))


def exclusion_audit(long_df: DataFrame, exclusions: DataFrame | None, specs=()) -> DataFrame:
    """Rows excluded per env, object, field and reason.  A hard-excluded row counts once,
    under its hard reason; only surviving rows can count under a comparison-only spec."""
    # Count first: the rules then see one row per env, object and field.
    counts = long_df.groupBy("env", "obj", "field").agg(F.count("*").alias("_n"))
    tagged = with_reason(counts, exclusions)
    table = spec_table(long_df.select("obj", "field"), specs)
    tagged = tagged.withColumn("spec", comparison_spec(specs)) if table is None else with_spec(tagged, table)
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(
        F.col("spec").isNotNull(), F.concat(F.lit(GLOB_REASON), F.col("spec")))
    return tagged.select("env", "obj", "field", reason.alias("reason"), F.col("_n").alias("excluded_row_count")).filter(
        F.col("reason").isNotNull())
