"""Session settings, size checks and lineage cuts."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_LIMIT = 64 << 20

# Settings that suit these jobs.  The sort-aggregate one lets the record-level step of the
# parity job use the order left by the field-level step rather than hash and spill.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; no job runs.  Unknown counts as too large."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, TypeError):
        return 1 << 62


def input_bytes(df: DataFrame) -> int:
    """Size of all tables a plan reads.  Join estimates multiply their sides and say little
    about real volume; the sum of the leaves does."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except (AttributeError, TypeError):
        return 1 << 62


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the estimate proves the table small.  Otherwise the
    join stays a shuffle join and adaptive execution decides with run-time sizes."""
    return F.broadcast(df) if size_in_bytes(df) <= limit else df


def config(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A configuration table in one partition, where the estimate proves it small: what is aggregated from it
    needs no exchange."""
    return df.coalesce(1) if size_in_bytes(df) <= limit else df


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one the session names in ``spark.checkpoint.dir``, else one
    beside the tables of its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A packed table under the shared folder, read back: cuts lineage like :func:`checkpointed` on a fraction of its disk."""
    folder = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def forget(*tables: DataFrame) -> None:
    """Delete what :func:`written` wrote, once nothing that is still to run reads it."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def walking(spark: SparkSession):
    """Settings of walks that write down every table they read twice.  Shuffle files go with the job that wrote them, not
    when the driver's memory is next cleaned; a join is broadcast by sizes at run time only, as packed tables are
    many times larger in memory."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    used = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": spark.conf.get(broadcast), broadcast: "-1"}
    before = {name: spark.conf.get(name, None) for name in used}
    for name, value in used.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder of the session (``spark.checkpoint.dir``)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
