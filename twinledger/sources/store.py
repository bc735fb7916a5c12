"""Partitioned storage of extracts and diffs, and review outputs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.payload import parse, to_text
from ..functions.text import cell
from ..operators.parity import records as record_view, shown_fields
from ..session import checkpointed, small
from . import manifest
from .extract import join_bucket

BUCKET_KEYS = ["obj", "join_bucket"]
DONE = "obj string, join_bucket string, config string, run string, record_rows long, field_rows long"
PAIRED = ("key string, new_record_id string, old_record_id string, external_id string, change_type string, items array<struct<field:string,"
          "new_value:string,old_value:string,in_new:boolean,in_old:boolean,differs:boolean,load_only:boolean>>, field_rows int, "
          "obj string, join_bucket string")
LIVE_OBJECTS = "obj string, run string"
RECORDS = ("obj string, new_record_id string, old_record_id string, external_id string, new_value string, old_value string, field_diff string, "
           "change_type string, new_load_value string, old_load_value string")


@dataclass(frozen=True)
class Written:
    """What a run has stored, counted while it was written."""
    run: str
    record_rows: int
    field_rows: int


def read_parts(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """A partitioned store whose partition values stay the text they were: ``024`` is a bucket, not a number."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return spark.read.option("mergeSchema", merge).parquet(path)
    finally:
        spark.conf.set(name, before)


def fixed_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns, in order, as text; missing ones are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select([(F.col(f"`{have[c.lower()]}`") if c.lower() in have else F.lit(None)).cast("string").alias(c) for c in columns])


def write_extract(long_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a bucketed extract by object and join bucket; a bucket that is written again replaces
    itself.  Rows of one bucket gather before the write, and large buckets split by their size."""
    (long_df.hint("rebalance", *BUCKET_KEYS).write.mode(mode).option("partitionOverwriteMode", "dynamic")
            .partitionBy(*BUCKET_KEYS).parquet(path))


def read_extract(spark: SparkSession, path: str, objects: list[str] | None = None, buckets: list[str] | None = None,
                 committed: DataFrame | None = None) -> DataFrame:
    """A stored extract, pruned to objects and buckets.  ``committed`` (``obj, chunk``) keeps
    only rows of finished chunks when the extract carries chunk numbers."""
    df = read_parts(spark, path)
    if objects is not None:
        df = df.filter(F.col("obj").isin(*objects))
    if buckets is not None:
        df = df.filter(F.col("join_bucket").isin(*buckets))
    if committed is not None:
        df = df.join(committed.select("obj", "chunk").distinct(), ["obj", "chunk"], "left_semi")
    return df


def object_names(long_df: DataFrame) -> DataFrame:
    return long_df.select(F.col("obj").alias("object")).distinct()


def bucket_of(paired: DataFrame, buckets: int) -> DataFrame:
    return paired.withColumn("join_bucket", join_bucket(F.col("key"), buckets))


def _live(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the last manifest: the run whose part is live for each bucket."""
    return manifest.last(spark, f"{path}/manifest", DONE)


def manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """What the store holds, a row per finished bucket: ``obj, join_bucket, config, run, record_rows, field_rows``."""
    live = _live(spark, path)[1]
    return spark.createDataFrame([], DONE) if live is None else live


def done_buckets(spark: SparkSession, path: str, config: str, resume: bool = True) -> DataFrame | None:
    """Buckets finished by earlier runs with the same settings; None for a fresh start.

    Other settings stop the run: finished and new buckets must not be mixed.  A fresh start makes
    everything stored so far invisible, by a manifest without rows.
    """
    number, live = _live(spark, path)
    if not resume:
        manifest.commit(spark.createDataFrame([], DONE), f"{path}/manifest", number)
        return None
    if live is None or live.isEmpty():
        return None
    if not live.filter(F.col("config") != config).isEmpty():
        raise ValueError("stored diff was made with other settings; start afresh to change them")
    return live


def skip_done(long_df: DataFrame, done: DataFrame | None) -> DataFrame:
    """Rows of buckets still to do."""
    return long_df if done is None else long_df.join(done.select(*BUCKET_KEYS).distinct(), BUCKET_KEYS, "left_anti")


def write_paired(paired: DataFrame, inputs: DataFrame, path: str, config: str, buckets: int = 32) -> Written:
    """Store diff parts by object and bucket and mark every bucket of ``inputs`` done, those
    without a difference included.

    Parts go to a folder of their own; the manifest that names them is written last and replaces the one before in one
    step.  A run that stops ahead of that changes nothing that is read.  Rows are counted in the pass that
    writes them, and what the manifest says is checked against that.
    """
    spark, run, seen = inputs.sparkSession, uuid.uuid4().hex, Observation()
    number, before = _live(spark, path)
    parts = bucket_of(paired, buckets).withColumn("field_rows", shown_fields())
    parts = parts.observe(seen, F.count("*").alias("record_rows"), F.coalesce(F.sum("field_rows"), F.lit(0)).alias("field_rows"))
    parts.hint("rebalance", *BUCKET_KEYS).write.partitionBy(*BUCKET_KEYS).parquet(f"{path}/paired/run={run}")
    none = F.lit(0).cast("long")
    counts = spark.read.schema(PAIRED).parquet(f"{path}/paired/run={run}").groupBy(*BUCKET_KEYS).agg(
        F.count("*").alias("record_rows"), F.sum("field_rows").cast("long").alias("field_rows"))
    done = inputs.select(*BUCKET_KEYS).distinct().join(counts, BUCKET_KEYS, "left").select(
        *BUCKET_KEYS, F.lit(config).alias("config"), F.lit(run).alias("run"), F.coalesce("record_rows", none).alias("record_rows"),
        F.coalesce("field_rows", none).alias("field_rows"))
    done = checkpointed(done)
    told = done.agg(F.coalesce(F.sum("record_rows"), none), F.coalesce(F.sum("field_rows"), none)).first()
    written = Written(run, *_observed(seen))
    if tuple(told) != (written.record_rows, written.field_rows):
        raise ValueError(f"the run wrote {written.record_rows} records and {written.field_rows} fields, but buckets of its inputs hold {told[0]} and {told[1]}")
    if before is not None:
        done = done.unionByName(before.join(done.select(*BUCKET_KEYS), BUCKET_KEYS, "left_anti"))
    manifest.commit(done, f"{path}/manifest", number)
    return written


def _observed(seen: Observation) -> tuple[int, int]:
    """What a write has counted; nothing where the planner found that there was nothing to write."""
    try:
        told = seen.get
    except Py4JJavaError:
        return 0, 0
    return told["record_rows"], told["field_rows"]


def read_paired(spark: SparkSession, path: str, objects: list[str] | None = None, buckets: list[str] | None = None) -> DataFrame:
    """The live part of every bucket, or of the named objects and buckets; an empty table if nothing is stored."""
    live = manifest_rows(spark, path).filter("record_rows > 0")
    for name, wanted in zip(BUCKET_KEYS, (objects, buckets)):
        if wanted is not None:
            live = live.filter(F.col(name).isin(*wanted))
    runs = [r.run for r in live.select("run").distinct().collect()]
    reader = spark.read.schema(f"{PAIRED}, run string")
    stored = reader.option("basePath", f"{path}/paired").parquet(*[f"{path}/paired/run={r}" for r in runs]) if runs else spark.createDataFrame([], f"{PAIRED}, run string")
    for name, wanted in zip(BUCKET_KEYS, (objects, buckets)):
        if wanted is not None:  # prunes folders
            stored = stored.filter(F.col(name).isin(*wanted))
    return stored.join(small(live.select(*BUCKET_KEYS, "run")), [*BUCKET_KEYS, "run"], "left_semi").drop("run", "field_rows")


def drop_dead_runs(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of runs that the manifest does not name: stopped or replaced ones.  Not while a run is writing."""
    live = {r.run for r in manifest_rows(spark, path).select("run").distinct().collect()}
    dead = [n for n in manifest.folders(spark, f"{path}/paired") if n.startswith("run=") and n[4:] not in live]
    for name in dead:
        manifest.remove(spark, f"{path}/paired/{name}")
    return dead


def write_record_parts(recs: DataFrame, path: str, objects: list[str] | None = None) -> None:
    """Reported records with payloads as JSON text, by object.  A run replaces the parts of ``objects``, those that
    have no difference any more included; without a list it replaces all.  As for diff parts, a manifest that
    is written last names what is live.  Records of other objects than the listed ones stop the run."""
    spark, run = recs.sparkSession, uuid.uuid4().hex
    number, before = manifest.last(spark, f"{path}/manifest", LIVE_OBJECTS)
    out = recs.select([to_text(F.col(c)).alias(c) if t == "map<string,string>" else (F.to_json(c).alias(c) if t.startswith("map") else F.col(c))
                       for c, t in recs.dtypes])
    out.hint("rebalance", "obj").write.partitionBy("obj").parquet(f"{path}/parts/run={run}")
    rows = spark.read.schema("change_type string, obj string").parquet(f"{path}/parts/run={run}").select("obj").distinct().withColumn("run", F.lit(run))
    if objects is not None:
        if not rows.filter(~F.col("obj").isin(*objects)).isEmpty():
            raise ValueError(f"records of other objects than {objects} were given")
        if before is not None:
            rows = rows.unionByName(before.filter(~F.col("obj").isin(*objects)))
    manifest.commit(rows, f"{path}/manifest", number)


def read_record_parts(spark: SparkSession, path: str, objects: list[str] | None = None,
                      change_types: list[str] | None = None) -> DataFrame:
    """Stored records for loading: object partitions pruned, change types pushed to the
    scan, payload JSON parsed.  Files without the load-only columns read as empty maps; an empty store is an empty table."""
    live = manifest.last(spark, f"{path}/manifest", LIVE_OBJECTS)[1]
    runs = [] if live is None else [r.run for r in live.select("run").distinct().collect()]
    if runs:
        name = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(name)
        spark.conf.set(name, "false")
        try:
            df = spark.read.option("mergeSchema", True).option("basePath", f"{path}/parts").parquet(*[f"{path}/parts/run={r}" for r in runs])
        finally:
            spark.conf.set(name, before)
        df = df.join(small(live), ["obj", "run"], "left_semi").drop("run")
    else:
        df = spark.createDataFrame([], RECORDS)
    if objects is not None:
        df = df.filter(F.col("obj").isin(*objects))
    if change_types is not None:
        df = df.filter(F.col("change_type").isin(*change_types))
    for name in ("new_value", "old_value", "new_load_value", "old_load_value"):
        source: Column = F.col(name) if name in df.columns else F.lit(None).cast("string")
        df = df.withColumn(name, parse(source))
    return df


def write_public(df: DataFrame, path: str) -> None:
    """The public columns of reported records (load-only payloads stay out)."""
    df.select([c for c in df.columns if not c.endswith("_load_value")]).write.mode("overwrite").parquet(path)


def csv_cells(df: DataFrame) -> DataFrame:
    """All columns as one-line CSV cells: maps as JSON, null as empty."""
    def as_text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "map<string,string>":
            return to_text(c)
        return F.to_json(c) if kind.startswith(("map", "array", "struct")) else c.cast("string")
    return df.select([cell(as_text(n, t)).alias(n) for n, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted UTF-8 CSV with a header.  No byte-order mark is written."""
    (csv_cells(df).write.mode("overwrite").option("header", True).option("quoteAll", True)
        .option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path))


def paired_records(spark: SparkSession, path: str) -> DataFrame:
    return record_view(read_paired(spark, path))

