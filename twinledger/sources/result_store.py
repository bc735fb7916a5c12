"""Results of load batches, kept as they end, with what reviewers ask of them: the last result of each record, errors,
examples and what is to be tried again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import RECORD_KEY, RESULT_COLUMNS
from ..operators.errors import classified, error_examples, error_summary
from ..operators.ranking import last_wins
from ..operators.state import failed
from . import manifest

BATCHES = "batch string, seq long"
STORED = ", ".join(f"{c} {'int' if c == 'payload_field_count' else 'string'}" for c in RESULT_COLUMNS) + ", batch string, seq long"


def keep_outcomes(results: DataFrame, store: str) -> int:
    """Store result rows as the next batch; returns its number.  Rows count once the manifest names their folder, so a
    batch that stops on the way leaves nothing behind that is read."""
    spark, name = results.sparkSession, uuid.uuid4().hex
    number, before = manifest.last(spark, f"{store}/manifest", BATCHES)
    results.select(*RESULT_COLUMNS).write.parquet(f"{store}/rows/batch={name}")
    row = spark.createDataFrame([(name, number + 1)], BATCHES)
    return manifest.commit(row if before is None else before.unionByName(row), f"{store}/manifest", number)


def stored_outcomes(spark: SparkSession, store: str) -> DataFrame:
    """All stored result rows with ``seq``, the number of their batch; an empty table if there are none."""
    live = manifest.last(spark, f"{store}/manifest", BATCHES)[1]
    if live is None:
        return spark.createDataFrame([], STORED).drop("batch")
    names = [r.batch for r in live.select("batch").collect()]  # a row per batch
    rows = spark.read.schema(STORED.removesuffix(", seq long")).option("basePath", f"{store}/rows").parquet(*[f"{store}/rows/batch={n}" for n in names])
    return rows.join(F.broadcast(live), "batch").drop("batch")


def last_outcomes(spark: SparkSession, store: str) -> DataFrame:
    """The last result of each record."""
    return last_wins(stored_outcomes(spark, store), RECORD_KEY, ["seq", "operation", "target_record_id"])


def error_report(spark: SparkSession, store: str, examples: int = 5) -> tuple[DataFrame, DataFrame]:
    """Failures among the last results: counts with a sample per error, and the first ``examples`` rows of each."""
    rows = classified(failed(last_outcomes(spark, store)))
    order = ["source_record_id", "target_record_id"]
    return error_summary(rows, order), error_examples(rows, order, examples)


def retry_list(spark: SparkSession, store: str) -> DataFrame:
    """Records whose last result is a failure."""
    return failed(last_outcomes(spark, store)).select(*RECORD_KEY).distinct()
