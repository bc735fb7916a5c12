"""Scope, sequence, policy and exclusion tables: reading, checking, filtering.

A scope row maps one old field to one new field.  Neutral columns are used throughout:
``old_object, old_field, new_object, new_field, ignore, value_map``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import metadata_text, strip, truthy
from ..operators.ranking import number_rows

# Header names of the stored files and the neutral names they get here.
SCOPE_HEADERS = {
    "SF 1.0 Object": "old_object", "SF 1.0 Field": "old_field",
    "SF 2.0 Object": "new_object", "SF 2.0 Field": "new_field",
    "Ignore": "ignore", "Transformation Logic (JSON)": "value_map",
}
SEQUENCE_HEADERS = {
    "Load_Order": "load_order", "Object": "object", "Enabled": "enabled",
    "Manual_Override_Order": "manual_override_order",
}
EXCLUSION_HEADERS = {"Obj": "obj", "Field": "field", "Reason": "reason"}
POLICY_HEADERS = {
    "Object": "object", "Required_Source_Env_When_Loaded": "required_source",
    "Policy": "policy", "Notes": "notes",
}
RECORD_TYPE_HEADERS = {n: n for n in (
    "sobjecttype", "source_developername", "source_recordtypeid",
    "target_developername", "target_recordtypeid")}

SCOPE_CELLS = ["old_object", "old_field", "new_object", "new_field"]


def read_table(spark: SparkSession, path: str, headers: dict[str, str], required: list[str]) -> DataFrame:
    """A header CSV of text columns, renamed; fails early when a required column is absent.
    ``row_no`` keeps the file order, which decides between repeated rows."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    by_name = {c.lstrip("﻿").strip().lower(): c for c in df.columns}
    found = {new: by_name.get(old.lower()) for old, new in headers.items()}
    missing = [n for n in required if not found.get(n)]
    if missing:
        raise ValueError(f"{path} lacks required column(s): {', '.join(missing)}")
    return df.select(
        *[(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()],
        F.monotonically_increasing_id().alias("row_no"))


def read_scope(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SCOPE_HEADERS, SCOPE_CELLS)


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SEQUENCE_HEADERS, ["object", "enabled", "load_order"])


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, EXCLUSION_HEADERS, ["obj", "field"])


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, POLICY_HEADERS, ["object", "required_source"])


def read_record_types(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RECORD_TYPE_HEADERS, [])


def read_field_names(spark: SparkSession, path: str) -> DataFrame:
    """A list of field names: a column called ``field`` in any case, else the first column.
    Blank names go; the first occurrence keeps its place in ``row_no``."""
    df = spark.read.csv(path, header=True)
    name = next((c for c in df.columns if c.strip().lower() == "field"), df.columns[0])
    return (df.select(strip(F.col(f"`{name}`")).alias("field"), F.monotonically_increasing_id().alias("row_no"))
              .filter(F.length("field") > 0).groupBy("field").agg(F.min("row_no").alias("row_no")))


def _order(df: DataFrame) -> Column:
    return F.col("row_no") if "row_no" in df.columns else F.lit(0)


def not_ignored(scope: DataFrame) -> DataFrame:
    return scope.filter(~truthy(F.col("ignore"))) if "ignore" in scope.columns else scope


def scope_fields(scope: DataFrame, side: str) -> DataFrame:
    """Distinct fields per object of one side (``old`` or ``new``), first occurrence first."""
    df = not_ignored(scope)
    return (df.select(strip(F.col(f"{side}_object")).alias("object"), strip(F.col(f"{side}_field")).alias("field"),
                      _order(df).alias("row_no"))
              .filter((F.length("object") > 0) & (F.length("field") > 0))
              .groupBy("object", "field").agg(F.min("row_no").alias("row_no")))


def scope_pairs(scope: DataFrame, side: str, both_sides: bool = False, honour_ignore: bool = True) -> DataFrame:
    """Distinct (object, field) pairs under the metadata blank rules.  ``both_sides`` keeps
    only rows whose old cells are filled as well."""
    df = not_ignored(scope) if honour_ignore else scope
    cells = {c: metadata_text(F.col(c)) for c in SCOPE_CELLS}
    if both_sides:
        df = df.filter(cells["old_object"].isNotNull() & cells["old_field"].isNotNull())
    return (df.select(cells[f"{side}_object"].alias("object"), cells[f"{side}_field"].alias("field"))
              .dropna().distinct())


def field_mappings(scope: DataFrame, direction: str = "old_to_new", honour_ignore: bool = True) -> DataFrame:
    """Rows with all four cells filled, as ``source_*`` / ``target_*`` pairs."""
    df = not_ignored(scope) if honour_ignore else scope
    source, target = ("old", "new") if direction == "old_to_new" else ("new", "old")
    value_map = F.col("value_map") if "value_map" in df.columns else F.lit(None).cast("string")
    out = df.select(*[metadata_text(F.col(c)).alias(c) for c in SCOPE_CELLS],
                    value_map.alias("value_map"), _order(df).alias("row_no")).dropna(subset=SCOPE_CELLS)
    return out.select(
        F.col(f"{source}_object").alias("source_object"), F.col(f"{source}_field").alias("source_field"),
        F.col(f"{target}_object").alias("target_object"), F.col(f"{target}_field").alias("target_field"),
        metadata_text(F.col("value_map")).alias("value_map"), "row_no")


def effective_order(df: DataFrame) -> Column:
    """Manual override when given, else the computed order."""
    return F.coalesce(metadata_text(F.col("manual_override_order")).try_cast("double"),
                      metadata_text(F.col("load_order").cast("string")).try_cast("double")).cast("int")


def enabled_objects(sequence: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Enabled objects with their effective order; ``only`` restricts by an object list."""
    out = (sequence.filter(truthy(F.col("enabled")))
                   .select(metadata_text(F.col("object")).alias("object"), effective_order(sequence).alias("position"))
                   .dropna(subset=["object"]))
    return out.join(only.select("object"), "object", "left_semi") if only is not None else out


def drop_foreign_sources(objects: DataFrame, policy: DataFrame, source_env: str) -> DataFrame:
    """Leave out objects whose policy names another source than the current one."""
    required = F.lower(strip(F.col("required_source")))
    blocked = (policy.filter((F.length(required) > 0) & (required != source_env.strip().lower()))
                     .select(strip(F.col("object")).alias("object")).filter(F.length("object") > 0))
    return objects.join(blocked, "object", "left_anti")


def in_sequence(df: DataFrame) -> DataFrame:
    """Sort by effective order, then name; objects without an order come last."""
    return df.orderBy(F.col("position").asc_nulls_last(), "object")


def placed(df: DataFrame) -> DataFrame:
    """The same order as a column: ``place`` counts from 1."""
    return number_rows(df, [], [F.col("position").asc_nulls_last(), "object"], "place")
