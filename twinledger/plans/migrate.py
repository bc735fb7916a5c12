"""Moving one wide table: field intersection, record-type mapping, upsert, outcome."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..functions.values import stored
from ..model import MIGRATION_KEY, RECORD_TYPE_ID
from ..operators.ranking import number_rows
from ..operators.schema_diff import is_safe_field
from ..session import small

DEVELOPER_NAME = "RecordTypeDeveloperName"
UNMAPPED = ("omit", "error")


def record_type_ids(df: DataFrame) -> DataFrame:
    """Distinct well-formed record-type ids of a table."""
    if RECORD_TYPE_ID not in df.columns:
        return df.limit(0).select(F.lit(None).cast("string").alias("record_type_id"))
    ids = df.select(strip(F.col(RECORD_TYPE_ID).cast("string")).alias("record_type_id"))
    return ids.filter(F.col("record_type_id").rlike(r"\A[A-Za-z0-9]{15,18}\z")).distinct()


def record_type_lookup(mapping: DataFrame, obj: str, target_ids: DataFrame) -> DataFrame:
    """Rows ``way, source_key, target_id``: by source id and by source developer name.  A
    mapping row without a target id may name a target developer name, looked up in
    ``target_ids`` (``developer_name, id``)."""
    order = F.col("row_no") if "row_no" in mapping.columns else F.lit(0)
    c = lambda n: F.nullif(strip(F.col(n)), F.lit(""))
    rows = mapping.filter(F.coalesce(F.lower(strip(F.col("sobjecttype"))), F.lit("")).isin("", obj.lower())).select(
        c("source_developername").alias("s_dev"), c("source_recordtypeid").alias("s_id"),
        c("target_developername").alias("t_dev"), c("target_recordtypeid").alias("t_id"), order.alias("row_no"))
    named = rows.join(small(target_ids.select(F.col("developer_name").alias("t_dev"), F.col("id").alias("_id"))), "t_dev", "left")
    by_dev = named.filter(F.col("s_dev").isNotNull() & (F.col("t_id").isNotNull() | F.col("t_dev").isNotNull())).select(
        F.lit("name").alias("way"), F.col("s_dev").alias("source_key"),
        F.coalesce("t_id", "_id", F.concat(F.lit("__DEVNAME__:"), "t_dev")).alias("target_id"), "row_no")
    by_id = rows.filter(F.col("s_id").isNotNull() & F.col("t_id").isNotNull()).select(
        F.lit("id").alias("way"), F.col("s_id").alias("source_key"), F.col("t_id").alias("target_id"), "row_no")
    return by_dev.unionByName(by_id).groupBy("way", "source_key").agg(
        F.max_by("target_id", F.struct("row_no", "target_id")).alias("target_id"))


def field_report(source: DataFrame, catalog: DataFrame) -> DataFrame:
    """Which fields are written, and why each other field is not.  ``catalog`` is that of the
    one target object."""
    spark = source.sparkSession
    from ..model import rows
    have = rows(spark, ["field"], [(c,) for c in source.columns]).withColumn("in_source", F.lit(True))
    target = catalog.select("field", F.col("type").alias("target_type"), is_safe_field().alias("_safe"), F.lit(True).alias("in_target"))
    both = have.join(target, "field", "full_outer").na.fill(False, ["in_source", "in_target"])
    shared = F.col("in_source") & F.col("in_target")
    reason = (F.when(F.col("field") == RECORD_TYPE_ID, "reserved_field").when(~shared, "missing_in_one_side")
               .when(F.col("target_type") == "reference", "lookup_field_excluded")
               .when(~F.col("_safe"), "not_writable_in_target")
               .when(F.col("field").isin("Id", MIGRATION_KEY), "excluded_other"))
    return both.select("field", "in_source", "in_target", F.lit("unknown").alias("source_type"), "target_type", reason.alias("reason"))


@dataclass(frozen=True)
class Move:
    """``attempts``: one row per source record with its payload and pre-check outcome;
    ``omitted``: reference values left out; ``fields``: the field report."""

    attempts: DataFrame
    omitted: DataFrame
    fields: DataFrame
    write_fields: list[str]
    lookup_fields: list[str]


def plan_move(source: DataFrame, catalog: DataFrame, record_types: DataFrame | None = None, on_unmapped: str = "omit") -> Move:
    """``source`` has ``Id``; ``record_types`` comes from :func:`record_type_lookup`."""
    if on_unmapped not in UNMAPPED:
        raise ValueError(f"on_unmapped must be one of {UNMAPPED}")
    report = field_report(source, catalog)
    # Column names of one table: bounded by its schema.
    names = [(r["field"], r["reason"]) for r in report.select("field", "reason").collect()]
    write = sorted(f for f, reason in names if reason is None)
    lookups = sorted(f for f, reason in names if reason == "lookup_field_excluded")
    text = lambda c: stored(F.col(f"`{c}`"), source.schema[c].dataType)
    key = F.coalesce(strip(F.col("Id").cast("string")), F.lit(""))
    has_id, has_dev = RECORD_TYPE_ID in source.columns, DEVELOPER_NAME in source.columns
    none = F.lit(None).cast("string")
    df = source.select(
        key.alias("record_key"), F.map_from_entries(F.array(*[F.struct(F.lit(f), text(f)) for f in write])).alias("values")
        if write else F.expr("map()").cast("map<string,string>").alias("values"),
        (F.nullif(F.col(RECORD_TYPE_ID).cast("string"), F.lit("")) if has_id else none).alias("_rt"),
        (F.nullif(strip(F.col(DEVELOPER_NAME)), F.lit("")) if has_dev else none).alias("_dev"))
    if record_types is not None:
        pick = lambda way, c: record_types.filter(F.col("way") == way).select(F.col("source_key").alias(c), F.col("target_id").alias(f"{c}_id"))
        df = df.join(small(pick("id", "_rt")), "_rt", "left").join(small(pick("name", "_dev")), "_dev", "left")
    else:
        df = df.withColumn("_rt_id", none).withColumn("_dev_id", none)
    asked = F.col("_rt").isNotNull() if has_id else F.col("_dev").isNotNull()
    found = F.when(asked, F.coalesce("_rt_id", "_dev_id"))
    error = F.when(asked & found.isNull() & F.lit(on_unmapped == "error"), F.concat(
        F.lit("No RecordType mapping for source " + ("id '" if has_id else "devname '")), F.col("_rt" if has_id else "_dev"), F.lit("'")))
    attempts = df.select(
        F.col("record_key"), "values", found.alias("record_type_id"),
        F.when(error.isNotNull(), "precheck_error").otherwise("pending").alias("result"), F.coalesce(error, F.lit("")).alias("errors"))
    targets = catalog.filter(F.col("type") == "reference").select("field", F.array_join("reference_to", ";").alias("reference_to"))
    omitted = source.select(key.alias("record_key"), F.inline(F.filter(F.array(*[
        F.struct(F.lit(f).alias("field"), text(f).alias("source_value")) for f in lookups]) if lookups else
        F.expr("array()").cast("array<struct<field:string,source_value:string>>"),
        lambda x: F.coalesce(x["source_value"], F.lit("")) != ""))).join(small(targets), "field", "left")
    return Move(attempts, omitted.select("record_key", "field", "source_value", "reference_to"), report, write, lookups)


def apply_move(move: Move, target: DataFrame, obj: str, batch_size: int = 10_000, new_id=lambda k: F.concat(F.lit("T"), k)) -> DataFrame:
    """Upsert by the migration key: per-row outcome and the batch each sent row fell into.
    ``target`` has ``object, record_id, external_id`` with the migration key as external id."""
    if not isinstance(batch_size, int) or batch_size <= 0:
        raise ValueError("batch_size must be a positive integer")
    sendable = F.col("result") == "pending"
    held = target.filter(F.col("object") == obj).groupBy(F.col("external_id").alias("record_key")).agg(F.min("record_id").alias("_id"))
    sent = number_rows(move.attempts.filter(sendable), [], ["record_key"], "_rank").withColumn(
        "batch_no", F.floor((F.col("_rank") - 1) / batch_size).cast("long")).drop("_rank").join(held, "record_key", "left")
    sent = sent.select("record_key", "values", "record_type_id", F.lit("success").alias("result"), "errors",
                       F.coalesce("_id", new_id(F.col("record_key"))).alias("target_id"),
                       F.when(F.col("_id").isNull(), "True").otherwise("False").alias("created"), "batch_no")
    held_back = move.attempts.filter(~sendable).select("*", F.lit("").alias("target_id"), F.lit("").alias("created"), F.lit(None).cast("long").alias("batch_no"))
    return sent.unionByName(held_back)


def move_summary(results: DataFrame, move: Move, obj: str) -> DataFrame:
    """One row: totals of the move."""
    return results.agg(
        F.count("*").alias("total_source"), F.count_if(F.col("result").isin("success", "error")).alias("attempted"),
        F.count_if(F.col("result") == "success").alias("success"), F.count_if(F.col("result") == "error").alias("failed")).select(
        F.lit(obj).alias("object"), "*", F.lit(len(move.write_fields)).cast("long").alias("matched_non_lookup_fields"),
        F.lit(len(move.lookup_fields)).cast("long").alias("lookup_fields_detected"))
