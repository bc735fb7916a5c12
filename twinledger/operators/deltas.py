"""Dropping payload entries that the target already holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import equivalent
from ..session import config, small
from .skew import spread_join


def field_types(catalog: DataFrame) -> DataFrame:
    """One map of field to type per object."""
    return config(catalog).groupBy(F.col("object").alias("target_object")).agg(
        F.map_from_entries(F.collect_set(F.struct("field", "type"))).alias("_types"))


def _same(e: Column, current: Column, types: Column) -> Column:
    kind = F.coalesce(F.element_at(types, e["name"]), F.lit(""))
    return (e["ext_field"].isNull() & F.coalesce(F.map_contains_key(current, e["name"]), F.lit(False))
            & equivalent(e["value"], F.element_at(current, e["name"]), kind))


def with_actual_deltas(df: DataFrame, current: Column, types: Column, when: Column) -> DataFrame:
    """Keep only entries that differ from ``current`` (map of field to value) by type."""
    checked = when & current.isNotNull()
    kept = F.filter("entries", lambda e: ~_same(e, current, types))
    same = F.transform(F.filter("entries", lambda e: _same(e, current, types)),
                       lambda e: F.concat(e["name"], F.lit(": already matches target value")))
    return (df.withColumn("_kept", F.when(checked, kept).otherwise(F.col("entries")))
              .withColumn("skipped", F.when(checked, F.concat("skipped", same))
                          .when(when, F.concat("skipped", F.array(F.lit("Actual delta check skipped: unable to query current target values"))))
                          .otherwise(F.col("skipped")))
              .drop("entries").withColumnRenamed("_kept", "entries"))


def actual_deltas(ops: DataFrame, current: DataFrame, catalog: DataFrame, when: Column) -> DataFrame:
    """Join the rows that need the check with the target's current values
    (``object, record_id, values``) and drop what is equal already."""
    asks = F.when(when, F.col("target_record_id"))
    known = current.select("object", "record_id", F.col("values").alias("_current"))
    joined = spread_join(ops.withColumn("_rid", asks), known, [F.col("target_object"), F.col("_rid")], ["object", "record_id"], "source_record_id")
    joined = joined.join(small(field_types(catalog)), "target_object", "left").withColumn(
        "_types", F.coalesce("_types", F.expr("map()").cast("map<string,string>")))
    return with_actual_deltas(joined, F.col("_current"), F.col("_types"), when).drop("_rid", "_current", "_types")
