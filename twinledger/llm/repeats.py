"""Windows that stand in more than one place, found without moving every window.

1. Each text is cut into segments (see ``windows``); a first shuffle counts the anchors, a second
   keeps the segments whose anchor stands more than once.
2. Segments of equal content (by a 128-bit digest of their bytes or words) collapse to one before any text
   moves: a group of copies, however large, is one row with a count.
3. Only segments whose anchor has several distinct contents need looking into.  One text of each
   is cut out and sent to the anchor's task, where an operator's own index (a suffix automaton,
   a suffix array) tells for each window where else it stands.
4. An anchor with more than ``crowd`` distinct contents (a common line in ever new company) would
   fill one task; its windows are split up, each window being its own key by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import small
from .common import limit_batches, same_row, stored
from .windows import byte_units, segments, word_bounds, word_codes

# Bytes of one in-task index.
SHARD_BYTES = 1 << 19
NO_ID = (1 << 63) - 1
# A "shared" window stands in so many pages, however small its site.
LEAST_PAGES = 3
BROADCAST = 8 << 20
RUNS = "array<struct<from:int,to:int,first:long>>"


@dataclass(frozen=True)
class Windows:
    """What counts as a window: ``length`` bytes or words, anchored by ``gram`` of them."""
    length: int
    gram: int
    words: bool
    # Which windows repeat: those that stand in a row of a smaller id ("earlier"), in enough distinct
    # pages of a site ("shared"), or in any other place ("anywhere").
    rule: str
    crowd: int = 2000

    def units(self, text: bytes) -> np.ndarray:
        return word_codes(text) if self.words else byte_units(text)

    def bounds(self, text: bytes):
        return word_bounds(text) if self.words else None

    def cut(self, text: bytes, bounds, start: int, windows: int) -> bytes:
        """The bytes of a segment."""
        end = start + windows + self.length - 1
        return text[bounds[0][start]:bounds[1][end - 1]] if self.words else text[start:end]


def _occurrences(docs: DataFrame, spec: Windows, content: bool) -> DataFrame:
    """Segments of all texts; without ``content`` only what anchors are counted by."""
    more = ["_page", "_site"] if spec.rule == "shared" else []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("_id"), batch.column("_h")
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            for found in segments([spec.units(t) for t in texts], spec.length, spec.gram, content):
                pick = pa.array(found.text)
                front = [pa.array(found.anchor), ids.take(pick)]
                if content:
                    front += [pa.array(found.content, pa.binary()), hashes.take(pick), pa.array(found.start.astype(np.int32)),
                              pa.array(found.windows.astype(np.int32)), pa.array((found.at - found.start).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*front, *(batch.column(c).take(pick) for c in more)], names=[f.split()[0] for f in fields])
    fields = ["anchor long", "_id long", *(["content binary", "_h long", "start int", "windows int", "at int"] if content else []), *(f"{c} long" for c in more)]
    return docs.mapInArrow(scan, ", ".join(fields))


def _first_id():
    """The smallest id; documents without an id come after all others."""
    return F.coalesce(F.min("_id"), F.lit(NO_ID))


def _last_id():
    return F.max(F.coalesce("_id", F.lit(NO_ID)))


def _segment_rows(docs: DataFrame, picked: DataFrame, spec: Windows, digests: bool) -> DataFrame:
    """Fetch the text of picked segments: as bytes, or as one digest per window."""
    wanted = picked.groupBy("_id", "_h").agg(F.collect_list(F.struct(
        "anchor", "content", "n", "first", "last", "start", "windows", "at")).alias("_wanted"))
    if spec.rule == "shared" or digests:
        # Few segments as a rule: sent to the texts, so that these need not move another time.
        wanted = small(stored(wanted, "wanted"), BROADCAST)
    joined = docs.join(wanted, same_row(docs, wanted)).select(docs["_text"], "_wanted")

    def scan(batches):
        for batch in batches:
            out = []
            texts = batch.column(0).cast(pa.binary())
            for i in range(batch.num_rows):
                text, rows = texts[i].as_py(), batch.column(1)[i].as_py()
                bounds = spec.bounds(text)
                for r in rows:
                    if digests:
                        for w in range(r["windows"]):
                            data = spec.cut(text, bounds, r["start"] + w, 1)
                            if spec.words:  # words count, not what stands between them
                                data = b" ".join(data.split())
                            out.append((r["anchor"], r["content"], r["n"], r["first"], r["last"], w,
                                        hashlib.blake2b(data, digest_size=16).digest()))
                    else:
                        out.append((r["anchor"], r["content"], r["n"], r["first"], r["last"], r["windows"], r["at"],
                                    spec.cut(text, bounds, r["start"], r["windows"])))
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
    kinds = ({"anchor": "long", "content": "binary", "n": "long", "first": "long", "last": "long", "w": "int", "digest": "binary"} if digests else
             {"anchor": "long", "content": "binary", "n": "long", "first": "long", "last": "long", "windows": "int", "at": "int", "data": "binary"})
    names = list(kinds)

    def typed(batches):
        want = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        target = pa.schema([(k, want[v]) for k, v in kinds.items()])
        for b in scan(batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, target)], schema=target)
    return joined.mapInArrow(typed, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def run_lengths(first: np.ndarray, keep: np.ndarray) -> list[dict]:
    """Maximal runs of equal ``first`` among the kept windows."""
    if not len(first):
        return []
    edge = np.flatnonzero((first[1:] != first[:-1]) | (keep[1:] != keep[:-1])) + 1
    starts = np.concatenate([[0], edge])
    ends = np.concatenate([edge, [len(first)]])
    return [{"from": int(a), "to": int(b), "first": int(first[a])} for a, b in zip(starts, ends) if keep[a]]


# Of the segments of a shard: bytes, occurrences, smallest and largest id, windows, place of the anchor.
Index = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[list[dict]]]


def _looked_up(rows: DataFrame, index: Index) -> DataFrame:
    """Run an index over shards: the complete anchor groups of a partition, some at a time."""
    def scan(batches):
        held: list[tuple] = []
        units = 0

        def flush():
            anchor, content, *numbers, data = zip(*held)
            found = index(list(data), *(np.array(x, dtype=np.int64) for x in numbers))
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(content, pa.binary()),
                 pa.array(found, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("first", pa.int64())])))],
                names=["anchor", "content", "runs"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and units >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, units = [], 0
                held.append(row)
                units += len(row[-1])
        if held:
            yield flush()
    placed = rows.repartition("anchor").sortWithinPartitions("anchor", "first", "content")
    return placed.mapInArrow(scan, f"anchor long, content binary, runs {RUNS}")


def _split_up(docs: DataFrame, crowded: DataFrame, spec: Windows) -> DataFrame:
    """Windows of crowded anchors, each counted under its own digest."""
    rows = stored(_segment_rows(docs, crowded, spec, digests=True), "crowded-windows")
    counted = rows.groupBy("digest").agg(F.sum("n").alias("_n"), F.min("first").alias("_first"), F.max("last").alias("_last"))
    if spec.rule == "shared":
        counted = counted.filter(F.col("_n") >= LEAST_PAGES).withColumn("_first", F.xxhash64("digest"))
    counted = stored(counted.filter("_n > 1").drop("_n", "_last"), "crowded-counts")
    return (rows.join(counted, "digest")
                .groupBy("anchor", "content")
                .agg(F.collect_list(F.struct(F.col("w").alias("from"), (F.col("w") + 1).cast("int").alias("to"),
                                             F.col("_first").alias("first"))).alias("runs")))


def _in_enough_pages(places: DataFrame, enough: DataFrame) -> DataFrame:
    """The places whose run stands in as many distinct pages of its site as ``enough`` asks for."""
    places = stored(places, "places")
    counted = places.groupBy("anchor", F.col("r.first").alias("_set")).agg(
        F.countDistinct("_page").alias("_p"), F.countDistinct(F.coalesce("_id", "_page")).alias("_i"), F.min("_site").alias("_site"))
    counted = counted.filter(F.least("_p", "_i") >= LEAST_PAGES).join(small(enough, BROADCAST), "_site").filter(F.least("_p", "_i") >= F.col("_least"))
    counted = stored(counted.select(F.col("anchor").alias("_anchor"), "_set"), "shared-runs")
    return places.join(small(counted, BROADCAST), (F.col("anchor") == F.col("_anchor")) & (F.col("r.first") == F.col("_set")))


def repeated_spans(docs: DataFrame, spec: Windows, index: Index, enough: DataFrame | None = None) -> DataFrame:
    """``_id, _h, spans`` for the rows of ``docs`` (see ``common.keyed``) with units to remove:
    ``spans`` are the begin and end units of windows that stand elsewhere, ends exclusive.

    For "shared" windows rows have a ``_page`` (copies of a page have the same) and a ``_site`` besides,
    no window stands on two sites, and ``enough`` has ``_site, _least``: in how many pages, counted by ``_page``
    and by id, a window has to stand.  The index then tells as ``first`` in which set of segments a window stands."""
    spark = docs.sparkSession
    limit_batches(spark)
    seen = _occurrences(docs, spec, content=False)
    if spec.rule == "anywhere":
        anchors = seen.groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1")
    elif spec.rule == "shared":
        anchors = seen.groupBy("anchor").agg(F.count("*").alias("_n"), F.min("_site").alias("_site"))
        anchors = anchors.filter(F.col("_n") >= LEAST_PAGES).join(small(enough, BROADCAST), "_site").filter("_n >= _least")
    else:
        anchors = seen.groupBy("anchor").agg(_first_id().alias("_a"), _last_id().alias("_b")).filter("_a < _b")
    # Written down, so that the join below deals both sides anew and can split a frequent anchor.
    anchors = stored(anchors.select("anchor"), "anchors")
    seen = _occurrences(docs, spec, content=True)
    live = stored(seen.join(small(anchors, BROADCAST) if spec.rule == "shared" else anchors, "anchor"), "live-segments")
    contents = live.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), _first_id().alias("first"), _last_id().alias("last"),
        F.min(F.struct("_id", "_h", "start", "windows", "at")).alias("_one"))
    kinds = contents.groupBy("anchor").agg(F.count("*").alias("d"))
    contents = stored(contents.join(kinds, "anchor").select("anchor", "content", "n", "first", "last", "d", "_one.*"), "contents")
    several = contents.filter((F.col("d") > 1) & (F.col("d") <= spec.crowd))
    crowded = contents.filter(F.col("d") > spec.crowd)
    alone = contents.filter("d = 1").select("anchor", "content", F.array(F.struct(
        F.lit(0).alias("from"), F.col("windows").alias("to"), F.xxhash64("content") if spec.rule == "shared" else F.col("first"))).cast(RUNS).alias("runs"))
    found = alone.unionByName(_looked_up(_segment_rows(docs, several, spec, digests=False), index))
    if not crowded.isEmpty():
        found = found.unionByName(_split_up(docs, crowded, spec).select("anchor", "content", F.col("runs").cast(RUNS)))
    more = ["anchor", "_page", "_site"] if spec.rule == "shared" else []
    places = live.join(found, ["anchor", "content"]).select("_id", "_h", "start", *more, F.explode("runs").alias("r"))
    if spec.rule == "shared":
        places = _in_enough_pages(places, enough)
    if spec.rule == "earlier":
        places = places.filter(F.coalesce("_id", F.lit(NO_ID)) > F.col("r.first"))
    return places.groupBy("_id", "_h").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("r.from")).alias("begin"),
        (F.col("start") + F.col("r.to") + (spec.length - 1)).alias("end"))).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint, ascending spans that cover the same units; touching spans become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without_spans(docs: DataFrame, spans: DataFrame, apply: Callable[[bytes, list[tuple[int, int]]], dict], schema: str,
                  carry: list[str]) -> DataFrame:
    """Join spans back to every row and let ``apply`` make its result columns."""
    rows = docs.join(spans, same_row(docs, spans), "left").select(*[docs[c] for c in carry], docs["_text"], spans["spans"])
    fields = [f.strip().split()[0] for f in schema.split(",")]
    full = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry], schema])

    def scan(batches):
        for batch in batches:
            texts = batch.column(len(carry)).cast(pa.binary()).to_pylist()
            made = [apply(t, merged(s)) for t, s in zip(texts, batch.column(len(carry) + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(carry)], *[pa.array([m[f] for m in made]) for f in fields]], names=[*carry, *fields])
    return rows.mapInArrow(scan, full)
