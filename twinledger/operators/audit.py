"""Counts, validity checks and review samples of a parity result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_api_name, is_field_path, truncated
from ..session import small
from .ranking import seeded_sample, top_per_group


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def record_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(_text("obj"), _text("change_type")).agg(F.count("*").alias("row_count"))


def field_counts(fields: DataFrame) -> DataFrame:
    return fields.groupBy(_text("obj"), _text("field"), _text("change_type")).agg(F.count("*").alias("row_count"))


def invalid_objects(counts: DataFrame, valid_objects: DataFrame) -> DataFrame:
    """Reported rows of objects that are unknown or have no legal name.  Takes the counts of
    :func:`record_counts`, so the check runs once per group, not once per row."""
    known = valid_objects.select(F.col("object").alias("obj")).distinct().withColumn("_known", F.lit(True))
    checked = counts.join(small(known), "obj", "left")
    return (checked.filter(F.col("_known").isNull() | ~is_api_name(F.col("obj")))
                   .groupBy("obj").agg(F.sum("row_count").alias("row_count")))


def invalid_pairs(counts: DataFrame, valid_objects: DataFrame, valid_pairs: DataFrame) -> DataFrame:
    """Reported (object, field) pairs that are out of scope or illegally named; takes the
    counts of :func:`field_counts`."""
    known = valid_objects.select(F.col("object").alias("obj")).distinct().withColumn("_known", F.lit(True))
    pairs = valid_pairs.select(F.col("object").alias("obj"), "field").distinct().withColumn("_pair", F.lit(True))
    checked = counts.join(small(known), "obj", "left").join(small(pairs), ["obj", "field"], "left")
    good = F.col("_known").isNotNull() & F.col("_pair").isNotNull() & is_api_name(F.col("obj")) & is_field_path(F.col("field"))
    return checked.filter(~good).groupBy("obj", "field").agg(F.sum("row_count").alias("row_count"))


def record_sample(records: DataFrame, k: int = 5, seed: int = 8451, key=("new_record_id", "old_record_id")) -> DataFrame:
    """``k`` records per (object, change type), cells cut to review length."""
    picked = seeded_sample(records, ["obj", "change_type"], list(key), k, seed)
    return picked.select(*[truncated(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in picked.dtypes])


def field_sample(fields: DataFrame, k: int = 5, order=("old_record_id", "new_record_id")) -> DataFrame:
    """First ``k`` rows per (object, field, change type)."""
    picked = top_per_group(fields, ["obj", "field", "change_type"], list(order), k)
    return picked.select(*[truncated(F.col(c)).alias(c) for c in picked.columns])


def summary(counts: DataFrame, bad_objects: DataFrame, per_field: DataFrame, bad_pairs: DataFrame,
            stored: DataFrame | None = None) -> DataFrame:
    """Metric and value rows: what the store declares against what was counted.

    ``stored`` are the rows of the diff store's manifest (``obj, join_bucket, record_rows, field_rows``), counted by the
    runs that wrote them; without a store those five metrics are null.
    """
    def row(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))

    def told(df: DataFrame, **metrics: Column) -> DataFrame:
        """One row of aggregates, as rows of metric and value."""
        one = df.agg(*[v.alias(k) for k, v in metrics.items()])
        return one.select(F.inline(F.array(*[row(k, F.col(k)) for k in metrics])))

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("long"))

    done = {"completed_bucket_count": F.count("*"), "record_part_count": F.count_if(F.col("record_rows") > 0),
            "field_part_count": F.count_if(F.col("field_rows") > 0), "manifest_record_diff_rows": total("record_rows"),
            "manifest_field_diff_rows": total("field_rows")}
    declared = told(stored, **done) if stored is not None else told(counts.limit(0), **{k: F.max(F.lit(None).cast("string")) for k in done})
    return (declared.unionByName(told(counts, audited_record_diff_rows=total("row_count"), record_level_scan_completed=F.lit("True")))
            .unionByName(told(bad_objects, invalid_record_object_rows=total("row_count")))
            .unionByName(told(per_field, audited_field_diff_rows=total("row_count"), unique_field_change_groups=F.count("*"), field_level_scan_completed=F.lit("True")))
            .unionByName(told(bad_pairs, invalid_field_pair_rows=total("row_count"))))
