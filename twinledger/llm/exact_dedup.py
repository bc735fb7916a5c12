"""Exact duplicates by a Grace hash join of the table with itself.

Contents are dealt to buckets by their hash; sizes are summed ahead on (hash, bytes) rows, and
buckets that are too large for a table are dealt again by another hash, as often as needed, so
that the texts themselves move once, into the shuffle's files.  A task then takes one bucket
after the other into an open-addressing table that compares complete contents.
The same table runs ahead of the shuffle and collapses copies that share a task, so a
large group of copies reaches its bucket as a few rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import small
from .common import limit_batches, stored

BUCKET_BYTES = 64 << 20
NO_ID = (1 << 63) - 1


class ContentTable:
    """Open addressing with linear probing; a slot holds the number of an entry."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, dtype=np.int64)
        self.hash: list[int] = []
        self.content: list[bytes] = []
        self.first: list[int] = []
        self.count: list[int] = []
        self.bytes = 0

    def _slot(self, h: int, content: bytes) -> int:
        at = h % len(self.slots)
        while (e := self.slots[at]) >= 0 and not (self.hash[e] == h and self.content[e] == content):
            at = (at + 1) % len(self.slots)
        return at

    def add(self, h: int, content: bytes, first: int, count: int) -> None:
        at = self._slot(h, content)
        e = self.slots[at]
        if e >= 0:
            self.first[e] = min(self.first[e], first)
            self.count[e] += count
            return
        self.slots[at] = len(self.content)
        self.hash.append(h)
        self.content.append(content)
        self.first.append(first)
        self.count.append(count)
        self.bytes += len(content)
        if len(self.content) * 2 > len(self.slots):
            old = self.slots
            self.slots = np.full(len(old) * 2, -1, dtype=np.int64)
            for e in range(len(self.content)):
                at = self.hash[e] % len(self.slots)
                while self.slots[at] >= 0:
                    at = (at + 1) % len(self.slots)
                self.slots[at] = e


def _combined(batches, bucket_bytes: int):
    """Collapse copies ahead of the shuffle; a full table is handed on and begun again."""
    def out(t: ContentTable, buckets: dict[int, str]):
        step = 256
        for a in range(0, len(t.content), step):
            b = slice(a, a + step)
            yield pa.RecordBatch.from_arrays(
                [pa.array([buckets[h] for h in t.hash[b]], pa.string()), pa.array(t.hash[b], pa.int64()),
                 pa.array(t.content[b], pa.binary()).cast(pa.string()), pa.array(t.first[b], pa.int64()),
                 pa.array(t.count[b], pa.int64())], names=["bucket", "h", "content", "first", "n"])
    table, buckets = ContentTable(), {}
    for batch in batches:
        for bucket, h, content, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
            table.add(h, content, first, 1)
            buckets[h] = bucket
        if table.bytes > bucket_bytes:
            yield from out(table, buckets)
            table, buckets = ContentTable(), {}
    yield from out(table, buckets)


def _groups(batches):
    """One table per bucket; contents that stand more than once come out."""
    def out(t: ContentTable):
        many = [e for e, n in enumerate(t.count) if n > 1]
        return pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(t.content[e]).digest() for e in many], pa.binary()),
             pa.array([t.first[e] for e in many], pa.int64()), pa.array([t.count[e] for e in many], pa.int64())],
            names=["digest", "first", "n"])
    table, held = ContentTable(), None
    for batch in batches:
        for bucket, h, content, first, n in zip(*(c.to_pylist() for c in (
                batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()), batch.column(3), batch.column(4)))):
            if bucket != held:
                if table.content:
                    yield out(table)
                table, held = ContentTable(), bucket
            table.add(h, content, first, n)
    if table.content:
        yield out(table)


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Groups of equal texts: ``key, keep_id, group_size, kept, text_sha256`` per input row.

    Texts are equal when identical after each run of white space became one space; null counts as
    empty.  The smallest id of a group stays.  Rows without an id come after all others; a
    group of such rows alone has a null ``keep_id``, and all of it is kept.  Rows that repeat
    the id that stays are kept as well.  Other columns are ignored.
    """
    limit_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("_id"), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t-\r]+", " ").alias("content"))
    rows = rows.withColumn("h", F.xxhash64("content"))
    sizes = stored(rows.groupBy("h").agg(F.max(F.octet_length("content")).cast("long").alias("bytes")), "content-sizes")
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    fan = max(1, math.ceil(2 * total / bucket_bytes))
    deal = lambda level, n: F.concat(F.lit("/"), F.pmod(F.xxhash64(F.lit(level), "h"), F.lit(n)).cast("string"))
    sizes, rows, level = sizes.withColumn("bucket", deal(0, fan)), rows.withColumn("bucket", deal(0, fan)), 0
    while True:
        over = stored(sizes.groupBy("bucket").agg(F.sum("bytes").alias("_b"), F.count("*").alias("_n"))
                           .filter((F.col("_b") > bucket_bytes) & (F.col("_n") > 1)).select("bucket", F.lit(True).alias("_over")), "overfull")
        if over.isEmpty():
            break
        level += 1
        again = F.when(F.col("_over"), F.concat("bucket", deal(level, 16))).otherwise(F.col("bucket"))
        sizes, rows = (t.join(small(over), "bucket", "left").withColumn("bucket", again).drop("_over") for t in (sizes, rows))
    texts = rows.select("bucket", "h", "content", F.coalesce("_id", F.lit(NO_ID)).alias("first"))
    combined = texts.mapInArrow(lambda b: _combined(b, bucket_bytes), "bucket string, h long, content string, first long, n long")
    groups = (combined.repartition("bucket").sortWithinPartitions("bucket")
                      .mapInArrow(_groups, "digest binary, first long, n long"))
    slim = rows.select("_id", F.sha2("content", 256).alias("text_sha256"))
    joined = slim.withColumn("digest", F.unhex("text_sha256")).join(groups, "digest", "left")
    keep = F.when(F.col("n").isNull(), F.col("_id")).when(F.col("first") < NO_ID, F.col("first"))
    return joined.select(F.col("_id").alias(key), keep.alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                         F.col("_id").eqNullSafe(keep).alias("kept"), "text_sha256")
