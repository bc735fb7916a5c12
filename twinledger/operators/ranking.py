"""Numbering, top-k, sampling and first/last-wins per group, safe for one very large group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed, small

# Up to this k Spark itself cuts each task's rows to k per group before shuffling.
PARTIAL_LIMIT = 1000
# Up to SMALL_K one window per group is enough, up to MERGED_K partial results are merged in steps of FAN tasks.
SMALL_K, MERGED_K, FAN = 100, 100_000, 32
# Rows that one numbering task is meant to sort.
TASK_ROWS = 50_000


def _sort(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def number_rows(df: DataFrame, group: list[str], order: list, name: str = "rank",
                upto: int | None = None) -> DataFrame:
    """Exact 1..n numbering of each group in the given order.

    Callers that keep only the first ``upto`` <= 1000 rows use a window, whose limit works ahead
    of the shuffle.  Otherwise rows are range-partitioned, into as many tasks as the input needs, and
    sorted by group and order, each partition numbers its own rows, and the counts of
    earlier partitions (one row per partition and group) are added: a group of any size is
    spread over many tasks.
    """
    if upto is not None and upto <= PARTIAL_LIMIT:
        by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
        return df.withColumn(name, F.row_number().over(by.orderBy(*_sort(order))).cast("long"))
    keys = [F.col(g) for g in group]
    # Ranges are found from a sample, which would otherwise run the input's plan once more.
    df = checkpointed(df)
    # Counted: the optimizer's size of joins with cut lineage is a product that has nothing to do with the rows.
    parts = max(1, -(-df.count() // TASK_ROWS))
    # The checkpoint freezes which row sits where, so both passes below agree.
    placed = checkpointed(
        df.repartitionByRange(parts, *keys, *_sort(order)).sortWithinPartitions(*keys, *_sort(order))
          .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    ids = [F.struct(*keys).alias("_group") if group else F.lit(0).alias("_group")]
    counts = placed.groupBy("_part", *ids).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = placed.withColumn("_group", ids[0]).alias("p").join(
        small(offsets).alias("o"),
        (F.col("p._part") == F.col("o._part")) & F.col("p._group").eqNullSafe(F.col("o._group")))
    return joined.select(*[F.col(f"p.{c}") for c in df.columns],
                         (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(name))


def _first(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows per group.  Spark cuts each task's rows to k per group ahead of the shuffle."""
    window = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(*_sort(order))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")


def merged_top(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """The first k rows per group, merged in steps like the partial results of an aggregate.

    Each task keeps k rows per group; those of ``FAN`` tasks are merged to k, and of ``FAN`` such tasks again, so the last
    task of a group reads k rows for every ``FAN`` squared tasks of the input instead of k for each.
    """
    name = "spark.sql.optimizer.windowGroupLimitThreshold"  # up to this k the cut works ahead of the shuffle
    conf = df.sparkSession.conf
    conf.set(name, str(max(int(conf.get(name)), k)))
    out = df.withColumn("_task", F.spark_partition_id())
    for width in (FAN, FAN * FAN):
        out = _first(out.withColumn("_some", F.floor(F.col("_task") / width)), [*group, "_some"], order, k)
    return _first(out.drop("_task", "_some"), group, order, k)


def top_per_group(df: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """The first k rows per group in the given order (which must leave no ties to be repeatable)."""
    if k <= SMALL_K:
        return _first(df, group, order, k)
    if k <= MERGED_K:
        return merged_top(df, group, order, k)
    return number_rows(df, group, order, "_rank", upto=k).filter(F.col("_rank") <= k).drop("_rank")


def seeded_sample(df: DataFrame, group: list[str], key: list[str], k: int, seed: int = 8451) -> DataFrame:
    """``k`` rows per group, chosen by a seeded hash of the row key: uniform, repeatable and
    independent of partitioning.  The hash is MD5 of seed and key, so that another engine can tell the same rows."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return top_per_group(df, group, [F.md5(F.concat_ws("|", F.lit(str(seed)), *text)), *key], k)


def _pick(df: DataFrame, keys: list[str], order: list[str], function) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(function(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (which must leave no ties): an aggregate, so
    duplicates collapse before the shuffle and a hot key never gathers in one task."""
    return _pick(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def step_sample(df: DataFrame, group: list[str], order: list, per_group: int, total: int | None = None) -> DataFrame:
    """At most ``per_group`` rows per group and ``total`` rows overall, in order."""
    out = top_per_group(df, group, order, per_group)
    if total is None:
        return out
    return top_per_group(out, [], [*group, *order], total)
