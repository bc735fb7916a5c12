"""Exact search for the highest inner products, by a table of distances to pivots.

Entries are whole numbers, ``floor(scale * entry)``.  For a query q and a row c, ``q . c = (|q|^2 + |c|^2 - |q - c|^2) / 2``, and
each pivot p gives ``|q - c| >= | |q - p| - |c - p| |``.  The largest of these over all pivots bounds a score from above; candidates
are looked at by falling bound until the bound is below the score that is still missing.

1. Pivots are rows of a bounded sample that lie far from each other.  Any pivots give exact results; good ones save work.
2. The pivot table, all rows with their distances, is range-partitioned by nearest pivot and cut into blocks.
3. Every query searches its own block first.  The k-th score found there is what others have to reach.
4. Queries are packed.  A pack goes to the blocks whose ranges of distances let any of its queries gain; a task holds one
   block and streams the packs past it.  Of each block and query at most k rows go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import input_bytes, small
from .common import limit_batches, stored
from .vectors import matrix, vector_rows

# Rows that pivots are chosen from, and how many are chosen.
SAMPLE, PIVOTS = 2000, 32
# Rows and bytes of a block, queries of a pack, input bytes of a partition of blocks.
BLOCK_ROWS, BLOCK_BYTES, PACK_ROWS, PART_BYTES = 4096, 4 << 20, 512, 32 << 20
# Candidates evaluated at first; twice as many each time after.
FIRST = 128
BROADCAST = 8 << 20
UNKNOWN_BYTES = 1 << 60
# Entries beyond are taken for this; sums below SAFE are exact in a double.
LARGEST, SAFE = float(1 << 52), 1 << 53
LONG = (1 << 63) - 1
# Part of a distance that rounding may have changed.
ROUND = 16 * np.finfo(float).eps

UNITS = T.StructType([T.StructField("unit", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("rows", T.ArrayType(T.LongType())),
                      T.StructField("mark", T.ArrayType(T.DoubleType())), T.StructField("width", T.IntegerType()),
                      T.StructField("vectors", T.BinaryType()), T.StructField("dists", T.BinaryType()),
                      T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType())),
                      T.StructField("top", T.DoubleType()), T.StructField("least", T.DoubleType())])
PLACED = "_id long, _row long, _mark double, _v array<double>, _d array<double>, _near int, _far double"


def _whole(rows: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * rows), -LARGEST, LARGEST)


def far_apart(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows that lie far from each other: each the farthest from those before it."""
    rows = np.unique(rows, axis=0)
    if not len(rows):
        return rows
    picked = [int((rows * rows).sum(axis=1).argmax())]
    near = ((rows - rows[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < min(count, len(rows)):
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((rows - rows[picked[-1]]) ** 2).sum(axis=1))
    return rows[picked]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row to each pivot; what one of them lacks counts as zeros."""
    width = max(rows.shape[1], pivots.shape[1])
    rows, pivots = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, pivots))
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(rows), 0))


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel(), pa.float64()))


def _placed(ids, rows, marks, vectors: np.ndarray, dists: np.ndarray) -> pa.RecordBatch:
    near = dists.argmin(axis=1).astype(np.int32) if dists.shape[1] else np.zeros(len(dists), dtype=np.int32)
    return pa.RecordBatch.from_arrays(
        [ids, rows, marks, _lists(vectors), _lists(dists), pa.array(near), pa.array(dists.min(axis=1, initial=np.inf))],
        names=["_id", "_row", "_mark", "_v", "_d", "_near", "_far"])


def _units(rows: DataFrame, most: int) -> DataFrame:
    """Rows of each partition, in its order, put together to units of at most ``most`` rows or ``BLOCK_BYTES``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, sizes = TaskContext.get().partitionId() << 33, [], 0

        def unit(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal number
            vectors, dists = matrix(batch.column("_v")), matrix(batch.column("_d"))
            marks = batch.column("_mark").to_pylist()
            number += 1
            return pa.RecordBatch.from_pylist([{
                "unit": number, "ids": batch.column("_id").to_pylist(), "rows": batch.column("_row").to_pylist(), "mark": marks,
                "width": vectors.shape[1], "vectors": vectors.tobytes(), "dists": np.ascontiguousarray(dists.T).tobytes(),
                "low": dists.min(axis=0).tolist(), "high": dists.max(axis=0).tolist(),
                "top": float((vectors * vectors).sum(axis=1).max()), "least": min(marks)}], schema=schema)

        def full() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                wide = len(batch.column("_v")[low]) + len(batch.column("_d")[low])
                limit = max(1, min(most, BLOCK_BYTES // (8 * max(1, wide))))
                if sizes >= limit:
                    yield unit(full())
                    held, sizes = [], 0
                part = batch.slice(low, limit - sizes)
                held.append(part)
                low, sizes = low + part.num_rows, sizes + part.num_rows
        if held:
            yield unit(full())
    schema = pa.schema([("unit", pa.int64()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("mark", pa.list_(pa.float64())),
                        ("width", pa.int32()), ("vectors", pa.binary()), ("dists", pa.binary()), ("low", pa.list_(pa.float64())),
                        ("high", pa.list_(pa.float64())), ("top", pa.float64()), ("least", pa.float64())])
    return rows.mapInArrow(scan, UNITS)


@dataclass
class Unit:
    """A block or a pack in a task.  ``dists`` has a row per pivot; an id that is null has ``known`` false."""
    ids: np.ndarray
    known: np.ndarray
    rows: np.ndarray
    mark: np.ndarray
    vectors: np.ndarray
    dists: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Unit:
        n, ids = len(row["ids"]), row["ids"]
        vectors = np.frombuffer(row["vectors"]).reshape(n, row["width"])
        out = cls(np.array([0 if i is None else i for i in ids], dtype=np.int64), np.array([i is not None for i in ids]), np.array(row["rows"], dtype=np.int64),
                  np.array(row["mark"]), vectors, np.frombuffer(row["dists"]).reshape(-1, n))
        out.norms = (vectors * vectors).sum(axis=1)
        out.widest = out.dists.max(axis=1, initial=0)
        out.entry = float(np.abs(vectors).max(initial=0))
        return out


def _scores(query: np.ndarray, rows: np.ndarray, safe: bool) -> np.ndarray:
    """Exact inner products: by doubles where those are exact, else by Python's numbers, cut to a long."""
    width = min(len(query), rows.shape[1])
    if safe:
        return rows[:, :width] @ query[:width]
    return np.array([max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(r, query)))) for r in rows[:, :width]], dtype=object)


def search(block: Unit, queries: Unit, at: int, k: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The best k rows of a block for one query (ties to the smaller id) among those that score ``reach`` or
    more, and their scores.  Rows of the query's own id are no candidates."""
    query, far = queries.vectors[at], queries.dists[:, at]
    size = float(query @ query)
    if len(far):
        apart = np.abs(block.dists - far[:, None]).max(axis=0) - ROUND * float((far + block.widest).max())
        bound = (size + block.norms - np.square(np.maximum(apart, 0))) / 2
    else:
        bound = (size + block.norms) / 2
    bound = np.maximum(bound + (1e-12 * (size + block.norms) + 1), -LONG - 1.0)
    able = bound >= reach
    if queries.known[at]:
        able &= ~(block.known & (block.ids == queries.ids[at]))
    left = np.flatnonzero(able)
    left = left[np.argsort(-bound[left], kind="stable")]
    safe = block.entry * float(np.abs(query).max(initial=0)) * max(1, len(query)) < SAFE
    picked, scores, step = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=float if safe else object), FIRST
    while len(left):
        if len(picked) >= k and bound[left[0]] < scores[-1]:
            break  # no row that is left can gain
        some, left, step = left[:step], left[step:], 2 * step
        picked, scores = np.concatenate([picked, some]), np.concatenate([scores, _scores(query, block.vectors[some], safe)])
        if safe and len(picked) > k:  # all that reach the k-th score, ties included
            enough = scores >= max(reach, np.partition(scores, len(scores) - k)[len(scores) - k])
        else:
            enough = scores >= reach
        picked, scores = picked[enough], scores[enough]
        order = np.lexsort((block.ids[picked], ~block.known[picked], -scores))[:k]
        picked, scores = picked[order], scores[order]
    return picked, scores


def _reach(scores: np.ndarray, k: int) -> float:
    """What another row has to score: the k-th score, or what a double holds below it."""
    if len(scores) < k:
        return -np.inf
    low = float(scores[k - 1])
    return low if abs(low) < SAFE else float(np.nextafter(low, -np.inf))


def _at_home(k: int):
    """From blocks to their queries, each with the score to reach."""
    def scan(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Unit.of(row)
                mine = np.flatnonzero(block.mark > 0)
                if len(mine):
                    reach = [_reach(search(block, block, i, k, -np.inf)[1], k) for i in mine.tolist()]
                    yield _placed(pa.array(block.ids[mine], mask=~block.known[mine]), pa.array(block.rows[mine]), pa.array(reach, pa.float64()),
                                  block.vectors[mine], np.ascontiguousarray(block.dists[:, mine].T))
    return scan


def _against(k: int):
    """From blocks, each followed by its packs, to the best rows per query and block."""
    def scan(batches):
        now, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["pack"] is None:
                    now, block = row["unit"], Unit.of(row)
                    continue
                if row["unit"] != now:
                    raise ValueError("a pack came without its block")
                pack, out = Unit.of(row), []
                for i, reach in enumerate(pack.mark.tolist()):
                    picked, scores = search(block, pack, i, k, reach)
                    out.append((np.full(len(picked), i), picked, [int(s) for s in scores]))
                query, picked = (np.concatenate([o[j] for o in out]) for j in (0, 1))
                if len(picked):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pack.rows[query]), pa.array(pack.ids[query], mask=~pack.known[query]), pa.array(block.ids[picked], mask=~block.known[picked]),
                         pa.array([s for o in out for s in o[2]], pa.int64())], names=["_row", "query_id", "vec_id", "score"])
    return scan


def pairs_of_units(blocks: DataFrame, packs: DataFrame) -> DataFrame:
    """``unit, pack``: the blocks in which any query of the pack may still gain."""
    block = blocks.select("unit", F.col("low").alias("_l"), F.col("high").alias("_h"), F.col("top").alias("_t"))
    pack = packs.select(F.col("unit").alias("pack"), "low", "high", "top", "least")
    most = lambda c: F.coalesce(F.array_max(c), F.lit(0.0))
    apart = F.greatest(most(F.zip_with("_l", "high", lambda a, b: a - b)), most(F.zip_with("low", "_h", lambda a, b: a - b)), F.lit(0.0))
    apart = F.greatest(apart - ROUND * (most(F.col("high")) + most(F.col("_h"))), F.lit(0.0))
    bound = (F.col("top") + F.col("_t") - apart * apart) / 2 + 1e-12 * (F.col("top") + F.col("_t")) + 1
    # Summaries only, a row per block and per pack.
    return block.join(small(pack, BROADCAST), F.greatest(bound, F.lit(-LONG - 1.0)) >= F.col("least")).select("unit", "pack")


def top_scores(embeddings: DataFrame, queries: Column, k: int = 5, vector: str = "embedding", key: str = "vec_id", scale: int = 256) -> DataFrame:
    """For the rows that ``queries`` picks, the k other rows of the highest inner products: ``query_id, rank, vec_id, score``.

    All rows are candidates but those of the query's own id; with fewer than k all of them are returned.  Ties go to the smaller id,
    rows without an id last.  Vectors that are null or hold a null, NaN or infinity take no part; shorter ones are filled
    up with zeros.  Rows that repeat are candidates, and queries, each for itself.  A null in ``queries`` picks nothing.  Entries beyond
    2 ** 52 after scaling count as that, scores beyond a long as its end, ahead of ranking.  Other columns are ignored.
    """
    spark = embeddings.sparkSession
    limit_batches(spark)
    rows = vector_rows(embeddings, vector, F.col(key).cast("long").alias("_id"), F.monotonically_increasing_id().alias("_row"),
                       F.when(queries, 1.0).otherwise(0.0).alias("_mark"))
    near_enough = rows.select("_v").orderBy(F.xxhash64("_v", "_id")).limit(SAMPLE).toArrow()
    sample = matrix(near_enough.column(0).combine_chunks()) if near_enough.num_rows else np.zeros((0, 0))
    pivots = far_apart(_whole(sample, scale), PIVOTS)

    def table(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = _whole(matrix(batch.column("_v")), scale)
                yield _placed(batch.column("_id"), batch.column("_row"), batch.column("_mark"), vectors, distances(vectors, pivots))
    size, parts = input_bytes(embeddings), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < UNKNOWN_BYTES:  # else the session's count of partitions stands in
        parts = max(parts, size // PART_BYTES)
    # The row's number splits rows that tie, copies of one vector above all.
    near = ["_near", "_far", "_row"]
    blocks = stored(_units(rows.mapInArrow(table, PLACED).repartitionByRange(parts, *near).sortWithinPartitions(*near), BLOCK_ROWS), "blocks")
    asked = blocks.mapInArrow(_at_home(k), PLACED)
    packs = stored(_units(asked.repartitionByRange(*near).sortWithinPartitions(*near), PACK_ROWS), "packs")
    content = [c for c in UNITS.names if c != "unit"]
    sent = packs.withColumnRenamed("unit", "pack").join(pairs_of_units(blocks, packs), "pack").select("unit", "pack", *content)
    both = blocks.select("unit", F.lit(None).cast("long").alias("pack"), *content).unionByName(sent)
    met = both.repartition(parts, "unit").sortWithinPartitions("unit", F.col("pack").asc_nulls_first())
    found = met.mapInArrow(_against(k), "_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
