"""Result state: what is done, what is pending, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import load_text
from ..model import RECORD_KEY
from .ranking import last_wins
from .skew import skew_join


def last_results(results: DataFrame, order: str = "seq") -> DataFrame:
    """The last result per (target object, source record)."""
    return last_wins(results, RECORD_KEY, [order])


def processed_keys(results: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Keys that need no more work.  Failures count as processed unless ``retry_failed``."""
    done = results
    if retry_failed:
        order = F.col("seq") if "seq" in results.columns else F.lit(0)
        done = results.groupBy(*RECORD_KEY).agg(F.max_by("success", F.struct(order, F.col("success"))).alias("success"))
        done = done.filter(F.upper("success") == "TRUE")
    keys = done.select(*[load_text(F.col(k)).alias(k) for k in RECORD_KEY])
    return keys.dropna().distinct()


def pending(work: DataFrame, results: DataFrame, retry_failed: bool = False) -> DataFrame:
    return work.join(processed_keys(results, retry_failed), RECORD_KEY, "left_anti")


def restrict(work: DataFrame, selected: DataFrame) -> DataFrame:
    """Only the sampled records."""
    return skew_join(work, selected.select(*RECORD_KEY).distinct(), RECORD_KEY, "left_semi")


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.coalesce(F.upper("success"), F.lit("")) != "TRUE")


def totals(results: DataFrame, by=("target_object", "change_type")) -> DataFrame:
    """Attempted, succeeded and failed rows; a skip is no attempt unless it failed."""
    ok = F.upper("success") == "TRUE"
    skipped = F.col("operation") == "skip"
    return results.groupBy(*by).agg(
        F.count_if(~(skipped & ok)).alias("attempted"), F.count_if(ok & ~skipped).alias("succeeded"),
        F.count_if(~ok).alias("failed"), F.count_if(skipped & ok).alias("skipped"))
