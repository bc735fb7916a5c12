"""Hot keys: joins around them, and finding them where an aggregate wants to know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import input_bytes

# What one task is meant to hold.  A key below it needs no care; input below it has no such key.
TASK_ROWS = 2_000_000
TASK_BYTES = 128 << 20
# Bins of key hashes that are counted ahead of any sketch.
BINS = 1 << 16
# Keys the sketch tracks: it finds every key that holds more than 1 / 300,000 of the rows or so.
TRACKED, FOUND = 400_000, 10_000


def key_hash(columns: list[Column]) -> Column:
    return F.xxhash64(*columns)


def _full_bins(hashed: DataFrame) -> list[int]:
    return [r["bin"] for r in hashed.groupBy(F.pmod("h", F.lit(BINS)).alias("bin")).count().filter(F.col("count") > TASK_ROWS).collect()]


def hot_keys(df: DataFrame, keys: list[str], raw: DataFrame | None = None) -> list[int]:
    """Hashes of the keys that hold more rows than one task should.

    One pass over the key columns counts bins of hashes; a key with too many rows fills its bin beyond them.  Only bins
    that are that full, commonly none, are looked at with a frequent-items sketch of fixed size.  The answer only
    steers the plan: a key that is missed, or a hash collision, changes no result.

    ``raw`` has the same keys as they were before text rules, all of their rows: where none of its bins is full, rules and
    bins of ``df`` are not worked out.  A key whose spellings are only together too many is not found then.
    """
    if input_bytes(df) <= TASK_BYTES:
        return []
    hashes = lambda rows: rows.dropna(subset=keys).select(key_hash([F.col(k) for k in keys]).alias("h"))
    if raw is not None and not _full_bins(hashes(raw)):
        return []
    hashed = hashes(df)
    place = F.pmod("h", F.lit(BINS))
    full = _full_bins(hashed)
    if not full:
        return []
    found = hashed.filter(place.isin(*full)).agg(F.expr(f"approx_top_k(h, {FOUND}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > TASK_ROWS]


def is_hot(keys: list[Column], hot: list[int]) -> Column:
    return key_hash(keys).isin(*hot) if hot else F.lit(False)


def spread_join(left: DataFrame, right: DataFrame, keys: list[Column], on: list[str], by: str) -> DataFrame:
    """Left join of rows, many of them without a key, to a table that may be read in buckets, whose partitions adaptive
    execution does not split.  ``keys`` are the object and id that a row of ``left`` asks for, ``on`` their columns in ``right``.
    Rows that ask for nothing are dealt out by the text column ``by`` under an object that no table has."""
    none = keys[0].isNull() | keys[1].isNull()
    asked = left.withColumn("_none", none).withColumn("_on0", F.when(F.col("_none"), "\0").otherwise(keys[0])).withColumn(
        "_on1", F.when(F.col("_none"), F.coalesce(F.col(by), F.lit(""))).otherwise(keys[1]))
    rest = [F.col(c) for c in right.columns if c not in on]
    return skew_join(asked, right.select(F.col(on[0]).alias("_on0"), F.col(on[1]).alias("_on1"), *rest), ["_on0", "_on1"], "left").drop("_none", "_on0", "_on1")


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join whose left side may hold hot keys, or many rows without a key.

    Adaptive execution sees the real partition sizes and splits what is too large, whatever
    the key, unless a side is read in buckets (:func:`spread_join`); forcing it keeps the split also where an aggregate follows.
    No rows are copied and no job runs while the plan is made.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not cover {how} joins")
    left.sparkSession.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return left.join(right, on, how)
