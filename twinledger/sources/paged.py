"""Reading a table in id ranges, some at a time, so that a stopped run goes on where it was.

Ranges come from quantiles of the ids and cover all of them; their plan is a folder of small files, a step per file.  A
stream over that folder reads the table's rows of one step after the other and stores them by page: what is
done is the stream's own checkpoint.  A step that was cut off is read again and replaces its pages.  A call that
is to read all of the rest takes several steps at a time, so that the number of passes does not follow the table's size.
"""

from __future__ import annotations

import json

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import checkpointed

# Ids that text ranges are found from.
SAMPLE = 100_000
# Finest quantiles asked for.
ACCURACY = 1_000_000
# Steps whose files one task writes.
STEPS_A_TASK = 50
# Batches in which a call without a limit reads a plan, at most; a call that is cut off repeats one of them.
BATCHES = 16


def page_bounds(df: DataFrame, id_col: str, size: int) -> list[tuple]:
    """Upper ends of the pages but the last, in order: about ``size`` rows lie between two.

    Numbers are cut by a sketch that one pass merges; texts by a sample of fixed size, chosen by hash.  Bounds only
    decide how even pages are: each id lies in exactly one.
    """
    if size < 1:
        raise ValueError("page size must be at least 1")
    ids = df.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull())
    if isinstance(df.schema[id_col].dataType, T.NumericType):
        ids = checkpointed(ids)
        pages = -(-ids.count() // size)
        if pages < 2:
            return []
        # One literal, whatever the number of pages.
        shares = F.from_json(F.lit(json.dumps([i / pages for i in range(1, pages)])), "array<double>")
        found = ids.agg(F.percentile_approx("id", shares, min(ACCURACY, 100 * pages)).alias("q")).first()["q"]
    else:
        ids = ids.select("id", F.xxhash64("id").alias("_h"))
        pages = -(-ids.count() // size)
        sample = sorted(r.id for r in ids.orderBy("_h", "id").limit(SAMPLE).collect())
        found = [sample[len(sample) * i // pages] for i in range(1, pages)] if sample else []
    return sorted(set(found))


def plan_pages(df: DataFrame, id_col: str, size: int, plan: str, pages_a_step: int = 8) -> int:
    """Write the plan of reading ``df`` in pages under ``plan``; returns the number of pages.  Rows without an id are a
    page of their own (``-1``)."""
    kind = df.schema[id_col].dataType.simpleString()
    ends = page_bounds(df, id_col, size)
    pages = [(i, low, high) for i, (low, high) in enumerate(zip([None, *ends], [*ends, None]))]
    rows = df.sparkSession.createDataFrame([*pages, (-1, None, None)], f"page long, low {kind}, high {kind}")
    step = F.floor(F.greatest("page", F.lit(0)) / pages_a_step).cast("long")
    tasks = -(-len(pages) // (pages_a_step * STEPS_A_TASK))
    rows.withColumn("step", step).repartition(tasks, "step").write.partitionBy("step").parquet(plan)
    return len(pages)


def _span(pages: list, id_col: str) -> Column:
    """A condition that holds for all ids of the pages and reaches the scan."""
    c, real = F.col(id_col), [p for p in pages if p.page >= 0]
    out = c.isNotNull() if real else F.lit(False)
    if real and None not in (lows := [p.low for p in real]):
        out = out & (c > F.lit(min(lows)))
    if real and None not in (highs := [p.high for p in real]):
        out = out & (c <= F.lit(max(highs)))
    return out | c.isNull() if len(real) < len(pages) else out


def _with_page(df: DataFrame, pages: list, id_col: str, kind: str) -> DataFrame:
    """The rows of the pages, with ``page``: a binary search among the upper ends."""
    real = sorted((p for p in pages if p.page >= 0), key=lambda p: p.page)
    listed = lambda values, t: F.array(*map(F.lit, values)).cast(f"array<{t}>")
    highs = [p.high for p in real if p.high is not None]
    ends, lows, c = listed(highs, kind), listed([p.low for p in real], kind), F.col(id_col)
    halves = [1 << b for b in reversed(range(len(highs).bit_length()))]
    # How many ends are below the id.
    at = F.aggregate(listed(halves, "int"), F.lit(0), lambda n, h: F.when((n + h <= len(highs)) & (F.get(ends, n + h - 1) < c), n + h).otherwise(n))
    rows = df.filter(_span(pages, id_col)).withColumn("_at", at)
    low = F.get(lows, F.col("_at"))
    page = F.when(c.isNull(), F.lit(-1)).when(low.isNull() | (c > low), F.get(listed([p.page for p in real], "long"), F.col("_at")))
    return rows.withColumn("page", page.cast("long")).drop("_at").filter(F.col("page").isNotNull())


def read_paged(df: DataFrame, id_col: str, plan: str, out: str, checkpoint: str, steps: int | None = None) -> bool:
    """Store the rows of ``df`` under ``out``, by ``page``, step by step as ``plan`` says; True when all is done.

    A call goes on after the last step that an earlier one finished, also if that was stopped or failed.  ``steps`` ends
    this call after so many.  The range of the pages is a filter that reaches the scan.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    done, enough = [0], [False]

    def copy(batch: DataFrame, number: int) -> None:
        if steps is not None and done[0] >= steps:
            enough[0] = True
            raise RuntimeError("enough steps for this call")
        pages = batch.select("page", "low", "high").collect()  # of some steps: their bounds
        rows = _with_page(df, pages, id_col, kind).hint("rebalance", "page")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("page").parquet(out)
        done[0] += 1
    planned = f"page long, low {kind}, high {kind}, step long"
    at_once = 1 if steps is not None else max(1, -(-spark.read.schema(planned).parquet(plan).select("step").distinct().count() // BATCHES))
    stream = spark.readStream.schema(planned).option("maxFilesPerTrigger", at_once).parquet(plan)
    query = stream.writeStream.foreachBatch(copy).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not enough[0]:
            raise
    return not enough[0]


def paged_rows(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What :func:`read_paged` has stored."""
    return spark.read.schema(schema).parquet(out).select(*schema.names)
