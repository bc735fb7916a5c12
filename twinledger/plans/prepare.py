"""From reported records to prepared work."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.payload import is_malformed, items_json, merged
from ..functions.text import load_text
from ..model import DATA_GAP, EXTERNAL_ID, MISSING_FROM, RECORD_KEY, WORK_COLUMNS
from ..operators.mapping import map_payload
from ..operators.ranking import first_wins
from ..operators.rules import operation_hint
from ..operators.state import pending, restrict
from ..session import config, small


def work_queue(records: DataFrame, mapping: DataFrame, objects: DataFrame | None = None, load_side: str = "old",
               change_types: list[str] | None = None, results: DataFrame | None = None,
               selected: DataFrame | None = None, retry_failed: bool = False) -> DataFrame:
    """One row per (target object, source record) to load.

    ``load_side`` is the side the data comes from: the diff joins new to old, the load reads
    the old side's values and writes to the new side (or the reverse).  By default gaps and
    records missing from the side being written are taken.  When several source objects feed
    one target and share an id, the first source object wins.
    """
    other = "new" if load_side == "old" else "old"
    kinds = change_types or [DATA_GAP, MISSING_FROM + other]
    routes = config(mapping).select("source_object", "target_object").distinct()
    load_only = F.col(f"{load_side}_load_value")
    rows = (records.filter(F.col("change_type").isin(*kinds)).select(
                F.col("obj").alias("source_object"), load_text(F.col(f"{load_side}_record_id")).alias("source_record_id"),
                load_text(F.col(f"{other}_record_id")).alias("target_record_id"), "change_type",
                merged(load_only, F.col(f"{load_side}_value")).alias("payload"),
                F.array_except(F.map_keys(load_only), F.map_keys(f"{load_side}_value")).alias("load_fields"))
            .filter(F.col("source_record_id").isNotNull())
            .join(small(routes), "source_object"))
    if objects is not None:
        rows = rows.join(small(objects.select(F.col("object").alias("target_object")).distinct()), "target_object", "left_semi")
    rows = rows.select(*WORK_COLUMNS, "payload", "load_fields")
    rows = first_wins(rows, RECORD_KEY[::-1], ["source_object", "target_record_id"])
    if results is not None:
        rows = pending(rows, results, retry_failed)
    return restrict(rows, selected) if selected is not None else rows


def key_fields(catalog: DataFrame) -> DataFrame:
    """Per target object: is there an external-id field, is it an upsert key, is it writable."""
    return config(catalog).filter(F.col("field") == EXTERNAL_ID).select(
        F.col("object").alias("target_object"), F.lit(True).alias("_key_known"), F.col("external_id").alias("_key_upsert"),
        F.col("createable").alias("_key_createable"), F.col("updateable").alias("_key_updateable")).dropDuplicates(["target_object"])


def with_operation(work: DataFrame, catalog: DataFrame) -> DataFrame:
    """Update when the target id is known, upsert when the external id is a key, else create."""
    out = work.join(small(key_fields(catalog).select("target_object", "_key_upsert")), "target_object", "left")
    operation = (F.when(load_text(F.col("target_record_id")).isNotNull(), "update")
                  .when(F.col("source_record_id").isNotNull() & F.coalesce("_key_upsert", F.lit(False)), "upsert").otherwise("create"))
    return (out.withColumn("operation", operation).drop("_key_upsert")
               .withColumn("hint", operation_hint(F.col("operation"), F.col("target_record_id"))))


@dataclass(frozen=True)
class Prepared:
    """``work``: rows with a payload, pending.  ``closed``: keys without anything to write."""

    work: DataFrame
    closed: DataFrame

    def stored(self) -> DataFrame:
        """Prepared rows in their stored form, payload and skip reasons as JSON."""
        return self.work.select(
            "target_object", "source_object", "source_record_id", F.coalesce("target_record_id", F.lit("")).alias("target_record_id"),
            "change_type", "operation", items_json(F.col("entries")).alias("payload_json"),
            F.to_json("skipped").alias("skipped_fields_json"), F.lit("pending").alias("status"))


def prepare_work(queue: DataFrame, mapping: DataFrame, catalog: DataFrame, inferred: DataFrame | None = None) -> Prepared:
    # A queue leaves its last aggregate by record.
    mapped = map_payload(with_operation(queue, catalog), mapping, catalog, inferred, keyed=inferred is None)
    has_any = F.size("entries") > 0
    return Prepared(mapped.filter(has_any), mapped.filter(~has_any).select(*RECORD_KEY, "skipped"))


def prepared_summary(work: DataFrame, results: DataFrame | None = None, status: str = "prepared") -> DataFrame:
    """Prepared and still pending rows per target object."""
    all_rows = work.groupBy("target_object").agg(F.count("*").alias("prepared_rows"))
    left = pending(work, results) if results is not None else work
    open_rows = left.groupBy("target_object").agg(F.count("*").alias("pending_rows"))
    return all_rows.join(open_rows, "target_object", "left").select(
        "target_object", "prepared_rows", F.coalesce("pending_rows", F.lit(0)).alias("pending_rows"), F.lit(status).alias("status"))


def split_malformed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose payload texts can be read, and the others with a ``reason``, to be put aside and looked at.  Blank text is an
    empty payload."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.coalesce(is_malformed(F.col(c)), F.lit(False))
    marked = df.withColumn("_bad", bad)
    return marked.filter(~F.col("_bad")).drop("_bad"), marked.filter("_bad").drop("_bad").withColumn("reason", F.lit("payload is no JSON object"))
