"""Numbered versions of a small table that names what is live in a store.

A version is written out of sight and gets its number by one rename, which fails if the number is taken.  Readers see
all of a version or the one before, whatever stops a writer; two writers cannot both follow the same version.  On
stores whose rename is no single step this holds as far as that store keeps it.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has made the next version."""


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where, spark.sparkContext._jsc.hadoopConfiguration()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path``; none if it does not exist."""
    _, where, conf = _path(spark, path)
    fs = where.getFileSystem(conf)
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()] if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    _, where, conf = _path(spark, path)
    where.getFileSystem(conf).delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    _, where, conf = _path(spark, path)
    where.getFileSystem(conf).mkdirs(where)


def last(spark: SparkSession, path: str, schema: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the last version; ``(0, None)`` if there is none."""
    numbers = [int(n[1:]) for n in folders(spark, path) if re.fullmatch(r"v\d+", n)]
    if not numbers:
        return 0, None
    number = max(numbers)
    return number, spark.read.schema(schema).parquet(f"{path}/v{number:09d}")


def commit(rows: DataFrame, path: str, after: int) -> int:
    """Make ``rows`` the version that follows ``after``, or raise :class:`Conflict`."""
    spark = rows.sparkSession
    hidden, named = f"{path}/.next-{uuid.uuid4().hex}", f"{path}/v{after + 1:09d}"
    rows.coalesce(1).write.parquet(hidden)
    hadoop, source, conf = _path(spark, hidden)
    target = hadoop.Path(named)
    gateway = spark.sparkContext._gateway
    plain = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(source.toUri(), conf).rename(source, target, plain)
    except Py4JJavaError as e:
        if not target.getFileSystem(conf).exists(target):
            raise
        remove(spark, hidden)
        raise Conflict(f"version {after + 1} of {path} was made by another writer") from e
    return after + 1
