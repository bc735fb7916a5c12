"""Comparison of two wide tables by a user-chosen identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..functions.values import stored
from .skew import skew_join

COLUMNS = ["uid", "source_id", "target_id", "field", "source_value", "target_value", "change_type"]


def _uid(c: Column, ignore_case: bool) -> Column:
    text = strip(c.cast("string"))
    return F.lower(text) if ignore_case else text


def compare_wide(left: DataFrame, right: DataFrame, left_uid: str, right_uid: str | None = None,
                 fields: list[str] | None = None, ignore_case: bool = True, id_col: str = "Id") -> DataFrame:
    """CHANGED rows per differing field of matched identifiers, SOURCE_ONLY and TARGET_ONLY
    rows for the rest.  An identifier that stands m times on the left and n times on the right gives m * n
    comparisons, as a merge does.

    Rows without an identifier are reported one-sided and never matched with each other.
    """
    right_uid = right_uid or left_uid
    shared = set(left.columns) & set(right.columns)
    wanted = fields if fields is not None else shared - {left_uid, right_uid, id_col}
    names = sorted(n for n in wanted if n in shared)

    def side(df: DataFrame, uid: str, prefix: str) -> DataFrame:
        record_id = F.col(id_col).cast("string") if id_col in df.columns else F.lit(None).cast("string")
        return df.select(_uid(F.col(uid), ignore_case).alias("uid"), record_id.alias(f"{prefix}_id"),
                         F.lit(True).alias(f"in_{prefix}"),
                         *[stored(F.col(f"`{n}`"), df.schema[n].dataType).alias(f"{prefix}_{i}") for i, n in enumerate(names)])

    source, target = side(left, left_uid, "source"), side(right, right_uid, "target")
    none = F.lit(None).cast("string")
    # The matched part is an inner join, so a hot identifier can be split; the one-sided
    # parts are anti joins against the other side's distinct identifiers.
    matched = skew_join(source.dropna(subset=["uid"]), target.dropna(subset=["uid"]), ["uid"], "inner")
    entries = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"source_{i}").alias("source_value"),
                                 F.col(f"target_{i}").alias("target_value")) for i, n in enumerate(names)])
    if names:
        changed = matched.select("uid", "source_id", "target_id", F.inline(F.filter(
            entries, lambda x: ~x["source_value"].eqNullSafe(x["target_value"]))))
    else:
        changed = matched.limit(0).select("uid", "source_id", "target_id", none.alias("field"),
                                          none.alias("source_value"), none.alias("target_value"))
    out = changed.withColumn("change_type", F.lit("CHANGED"))
    for one, other, label in ((source, target, "source"), (target, source, "target")):
        alone = one.join(other.select("uid").distinct(), "uid", "left_anti")
        out = out.unionByName(alone.select(
            "uid", *[F.col(c) if c == f"{label}_id" else none.alias(c) for c in ("source_id", "target_id")],
            none.alias("field"), none.alias("source_value"), none.alias("target_value"),
            F.lit(f"{label.upper()}_ONLY").alias("change_type")))
    return out.select(*COLUMNS)


def in_order(delta: DataFrame) -> DataFrame:
    return delta.orderBy("change_type", F.col("uid").asc_nulls_last(), F.col("field").asc_nulls_last())
