"""Row keys, stored intermediates and Arrow batch limits shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_folder

WORD = r"[^ \t-\r]+"
# Rows and bytes of one Arrow batch: what a Python worker holds of its input at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def limit_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Write a table under the shared folder, packed well, and read it back: cuts lineage, survives lost
    executors, and gives the optimizer the table's real size.  A higher ``level`` packs texts tighter and takes longer."""
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def keyed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``_id, _h, _text`` per row.  The hash tells rows of a repeated id apart; rows that share
    both are the same document written twice and get the same result."""
    return docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_h"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_h"] == right["_h"])


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")
