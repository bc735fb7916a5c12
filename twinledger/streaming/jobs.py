"""Streams: extracting records as they arrive, and keeping result state current."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.failures import masked
from ..model import RECORD_KEY
from ..operators.errors import ERROR_KEY, classified, spread
from ..operators.ranking import first_wins, last_wins
from ..operators.state import failed
from ..sources.extract import tolerant_select, unpivot_records, with_bucket
from ..sources.manifest import make_folder


KEYS = ", ".join(f"{k} string" for k in RECORD_KEY)
STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_extract(spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str, env: str, obj: str,
                   side: str, fields: list[str], id_col: str = "Id", ext_id_col: str | None = None, buckets: int = 32,
                   max_files: int | None = None) -> StreamingQuery:
    """Flatten newly arrived files of one table, each exactly once; stops when caught up."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(path)
    good, _ = tolerant_select(df, env, obj, fields)
    long_df = with_bucket(unpivot_records(df, obj, id_col, good, env, ext_id_col), side, buckets)
    return (long_df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .partitionBy("obj", "join_bucket").trigger(availableNow=True).start())


def running_error_counts(results: DataFrame) -> DataFrame:
    """Failures per error as results arrive; run in update or complete mode.  Messages are masked, so
    state holds one counter per kind of error, however many records fail."""
    rows = classified(spread(failed(results))).withColumn("error_message", masked(F.col("error_message")))
    return rows.groupBy(*ERROR_KEY).agg(F.count("*").alias("row_count"))


def keep_error_counts(results: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Keep the running counts as a table under ``store``, one folder per batch that changed them.
    Read it back with :func:`stored_error_counts`."""
    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(store)
    return (running_error_counts(results).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _stored(spark: SparkSession, path: str, empty: str) -> DataFrame:
    """What batches have written so far; a table without rows if none has."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:  # nothing stored yet
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], empty)
        raise


COUNTS = ", ".join(f"{k} string" for k in ERROR_KEY) + ", row_count long, batch long"


def stored_error_counts(spark: SparkSession, store: str) -> DataFrame:
    """The last count of every error."""
    return last_wins(_stored(spark, store, COUNTS), ERROR_KEY, ["batch"]).drop("batch")


def compact_error_counts(spark: SparkSession, store: str, into: str) -> None:
    """Write the last counts as one batch of a new store.  Counts of a stream that goes on into that store replace them,
    as its state holds them too."""
    stored_error_counts(spark, store).withColumn("batch", F.lit(-1)).write.mode("overwrite").partitionBy("batch").parquet(into)


def keep_results(results: DataFrame, store: str, checkpoint: str, order: str = "seq") -> StreamingQuery:
    """Append each batch's last result per record under ``store``, one folder per batch, so
    that a replayed batch replaces itself.  Read it back with :func:`stored_results`."""
    def write(batch: DataFrame, number: int) -> None:
        last_wins(batch, RECORD_KEY, [order]).withColumn("batch", F.lit(number)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(store)
    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_results(spark: SparkSession, store: str, order: str = "seq") -> DataFrame:
    """The last result per record over all batches."""
    empty = f"{KEYS}, {order} long, batch long"
    return last_wins(_stored(spark, store, empty).drop("batch"), RECORD_KEY, [order])


def compact_results(spark: SparkSession, store: str, into: str, order: str = "seq") -> None:
    """Write the last results as one batch of a new store, to be read (and added to) from then on."""
    stored_results(spark, store, order).withColumn("batch", F.lit(-1)).write.mode("overwrite").partitionBy("batch").parquet(into)


def result_keys(spark: SparkSession, store: str) -> DataFrame:
    """The keys of results as they are stored, as a stream.  The folder may still be empty."""
    make_folder(spark, store)
    return spark.readStream.schema(KEYS).parquet(store)


JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _comparable(name: str, kind: T.DataType) -> Column:
    """A column in a type that keeps its order, and its nulls, in Python."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.BooleanType):
        c = c.cast("int")
    elif isinstance(kind, T.StringType):
        return c
    return c.cast("double") if isinstance(kind, (T.DoubleType, T.FloatType)) else c.cast("decimal(38,18)" if isinstance(kind, T.DecimalType) else "decimal(20,0)")


def fresh_work(work: DataFrame, results: DataFrame | None, out: str, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """Pass on arriving work that has no result yet, once per key over all batches: the first row of its batch by
    ``order`` (all other columns, if not given; nulls first).

    ``work`` and ``results`` (``target_object, source_record_id``, see :func:`result_keys`) are streams.  What is known of a key
    is one flag in Spark's state store (RocksDB, so it may outgrow memory): a batch looks up the keys that arrive in it
    and nothing else.  A result counts ahead of work of the same batch.  The sink's log makes a replayed
    batch write once.  Rows without a complete key are left out, as nothing tells them apart.  Columns to order by
    are of simple types.
    """
    spark, kinds = work.sparkSession, {f.name: f.dataType for f in work.schema}
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE)
    by = order or [c for c in work.columns if c not in RECORD_KEY]
    places = [f"_by{i}" for i in range(len(by))]
    rows = work.select(*RECORD_KEY, F.to_json(F.struct(*[F.col(f"`{c}`") for c in work.columns]), JSON).alias("_row"), F.lit(False).alias("_done"),
                       *[_comparable(c, kinds[c]).alias(p) for c, p in zip(by, places)])
    if results is not None:
        given = {f.name: f.dataType for f in rows.schema}
        rows = rows.unionByName(results.select(*[F.col(k).cast(given[k]).alias(k) for k in RECORD_KEY], F.lit(None).cast("string").alias("_row"), F.lit(True).alias("_done"),
                                               *[F.lit(None).cast(given[p]).alias(p) for p in places]))

    def rank(values):
        return tuple((v is not None and v == v, v if v is not None and v == v else 0) for v in values)

    def decide(key, parts, state):
        first, done = None, state.exists
        for part in parts:
            done = done or bool(part["_done"].any())
            if not done:
                here = min(zip(map(rank, zip(*(part[p] for p in places))) if places else [()] * len(part), part["_row"]))
                first = here if first is None else min(first, here)
        if not state.exists:
            state.update((True,))
        if not done:
            yield pd.DataFrame({"_row": [first[1]]})
    fresh = rows.dropna(subset=RECORD_KEY).groupBy(*RECORD_KEY).applyInPandasWithState(
        decide, "_row string", "known boolean", "append", GroupStateTimeout.NoTimeout)
    made = fresh.select(F.from_json("_row", work.schema, JSON).alias("_row")).select("_row.*")
    return made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_arrivals(work: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Duplicates of a key dropped within a watermark, for work that carries a time."""
    return work.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(RECORD_KEY)
