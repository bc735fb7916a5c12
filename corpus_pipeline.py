"""Cleaning and mixing of a training corpus, stage by stage.

Each stage takes what its predecessor kept and returns documents (all columns, texts as they are by
then); the last returns what the mix takes of each document.  ``run`` writes every
stage as Parquet under the shared folder of the session and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.llm.common import read, stored
from twinledger.llm.decontaminate import drop_contaminated
from twinledger.llm.language import keep_identified
from twinledger.llm.line_dedup import drop_repeated_lines
from twinledger.llm.mixing import mix_sources
from twinledger.llm.near_dedup import near_groups


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: at least half of the words' marginals in one."""
    return keep_identified(docs, least=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that resemble an earlier line go; a document all of whose lines went goes with them."""
    out = drop_repeated_lines(docs, percent=80, carry=True)
    out = out.filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^ \t-\r]"))
    lengths = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return out.select(*[lengths.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8.  Columns pass as they are,
    whatever their names."""
    kept = near_groups(docs, words=5, percent=80, rows_too=True).filter("_stays")
    kept = stored(kept.select(F.col("doc_id").alias("_kept"), F.col("_h").alias("_same"), (F.col("n_shingles") == 0).alias("_empty")).distinct(), "kept-rows")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_key"), F.xxhash64("text").alias("_own"))
    out = rows.join(kept, F.col("_key").eqNullSafe(F.col("_kept")) & (F.col("_own") == F.col("_same")))
    # Rows of the same id and text are one document; texts without words are copies of nothing.
    alone = F.col("_key").isNull() & F.col("_empty")
    again = out.filter(~alone).groupBy("_key", "_own").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return again.select("row").unionByName(out.filter(alone).select("row")).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark passages go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"), length=13, one_in=20)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of each document."""
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language identification", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

# The language stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
