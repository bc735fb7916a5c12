"""Classifying failed results and grouping them for review."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.failures import advice, category, masked, with_parsed_error
from ..functions.payload import key_list
from ..functions.text import load_text, strip
from .ranking import number_rows, top_per_group

ERROR_KEY = ["target_object", "source_object", "operation", "error_category", "error_code", "error_fields", "error_message"]


def spread(results: DataFrame) -> DataFrame:
    """Results dealt evenly to tasks.  Parsing a message takes far longer than reading it, and a small file is read by one or two tasks."""
    return results.repartition(int(results.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def classified(results: DataFrame) -> DataFrame:
    """Add error category, code, fields and message parsed from the raw message."""
    return with_parsed_error(results).withColumn(
        "error_category", category(F.col("operation"), F.col("error_code"), F.col("error_message")))


def _sample(names: list[str], order: list[str], df: DataFrame):
    have = [n for n in names if n in df.columns]
    return F.min_by(F.struct(*have), F.struct(*order)), have


def error_summary(failed: DataFrame, order: list[str]) -> DataFrame:
    """Count and first sample per error, by the seven key columns.  Aggregates combine ahead
    of the shuffle, so an error that makes up most rows stays cheap."""
    clean = failed.select(*[F.coalesce(load_text(F.col(k)), F.lit("")).alias(k) for k in ERROR_KEY],
                          *[c for c in failed.columns if c not in ERROR_KEY])
    sample, names = _sample(["source_record_id", "target_record_id", "payload_field_count", "payload_json", "message"], order, clean)
    out = clean.groupBy(*ERROR_KEY).agg(F.count("*").alias("row_count"), sample.alias("_s"))
    return out.select(*ERROR_KEY, "row_count", *[F.col(f"_s.{n}").alias(f"sample_{n}") for n in names])


def error_examples(failed: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """First ``k`` rows per error."""
    clean = failed.select(*[F.coalesce(load_text(F.col(c)), F.lit("")).alias(c) if c in ERROR_KEY else F.col(c) for c in failed.columns])
    return top_per_group(clean, ERROR_KEY, order, k)


def group_failures(failed: DataFrame, order: list[str]) -> DataFrame:
    """Failures grouped after masking record ids, with a sample and a first-look note."""
    text = lambda c: F.coalesce(strip(F.col(c).cast("string")), F.lit(""))
    keys = ["target_object", "source_object", "operation", "change_type", "error_category", "error_code", "error_fields"]
    norm = F.coalesce(F.nullif(masked(F.col("error_message")), F.lit("")), masked(F.col("message")))
    prepared = failed.select(
        *[text(k).alias(k) for k in keys], norm.alias("normalized_error_message"), masked(F.col("message")).alias("normalized_raw_message"),
        text("source_record_id").alias("source_record_id"), text("target_record_id").alias("target_record_id"),
        text("payload_field_count").alias("payload_field_count"), key_list(F.col("payload_json")).alias("payload_fields"),
        text("payload_json").alias("payload_json"), text("message").alias("message"), F.struct(*order).alias("_at"))
    kept = ["source_record_id", "target_record_id", "payload_field_count", "payload_fields", "payload_json", "message", "normalized_raw_message"]
    out = prepared.groupBy(*keys, "normalized_error_message").agg(
        F.count("*").alias("occurrence_count"), F.min_by(F.struct(*kept), "_at").alias("_s"))
    out = out.select("occurrence_count", *keys, "normalized_error_message",
                     *[F.col(f"_s.{n}").alias(f"sample_{n}" if n != "normalized_raw_message" else n) for n in kept])
    note = advice(F.col("target_object"), F.col("error_code"), F.col("error_category"), F.col("error_fields"),
                  F.concat("normalized_error_message", F.lit(" "), "sample_message"), F.col("sample_payload_fields"))
    return out.withColumn("investigation_context", note)


def review_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("occurrence_count").desc(), "target_object", "error_code", "normalized_error_message")


def review_places(df: DataFrame) -> DataFrame:
    """The review order as a column ``place``, from 1; what is equal in it is told apart by the other columns of a group."""
    rest = ["source_object", "operation", "error_category", "error_fields"]
    return number_rows(df, [], [F.col("occurrence_count").desc(), "target_object", "error_code", "normalized_error_message", *rest], "place")
