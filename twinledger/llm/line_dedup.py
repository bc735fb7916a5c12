"""Removal of lines that resemble an earlier line, by an exact set-similarity join.

A line is the set of its words (A-Z lowered).  Two lines match if their sets have a Jaccard
similarity of ``percent`` or more.  Words are ordered by how rare they are; two lines that match share a word among
the first n - ceil(percent * n) + 1 of each (prefix filter), have similar sizes (length filter), enough
words left behind the shared one (positional filter), and parity bits of their words that differ in no more places
than words may differ.  What passes is compared completely.

The order of words comes from a table of fixed size: counts of hashed words.  Any order that all
lines share keeps the join exact; rare words first only makes it fast.  As a count is never too small,
it also tells words that stand in one line only, and words whose lists are surely short.

Equal sets are one class, numbered in the order in which they first stand.  Only whether a class
matches an earlier one matters, so the pairs of a group are not listed: each class names the earliest four candidates that pass the
filters, and only those that turn out to match none of them name more.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import small
from .common import keyed, limit_batches, same_row, stored
from .windows import mix, word_bounds, word_codes

COUNT_BITS, NAME_BITS, CHUNKS = 22, 40, 64
SHORT_LIST, BLOCK = 1024, 4096
# Candidates that a class names first; tables of counts that are added at once, and how often.
MORE, FAN, LEVELS = 4, 64, 3
# Bytes of text taken at once in a task, and classes a task remembers to have listed.
PIECE, REMEMBERED = 1 << 20, 500_000
# Rows looked at together for pairs.
PAIR_ROWS = 50_000
BROADCAST = 8 << 20


def _pieces(texts: list[bytes]):
    """Numbers of some texts at a time, about a megabyte."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < PIECE):
            size += len(texts[high])
            high += 1
        yield low, high
        low = high


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes of several texts, and for each word its text and line."""
    joined = b"\n".join(texts).lower()
    bounds = word_bounds(joined)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    breaks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 10)
    line = np.searchsorted(breaks, bounds[0])
    text = np.searchsorted(ends, bounds[0], side="right")
    return word_codes(joined), text, line - np.searchsorted(breaks, ends - sizes)[text]


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _line_sets(texts: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct words of every line of several texts, in the common order: code, text, line; and
    where each line begins."""
    codes, text, line = _words(texts)
    if not len(codes):
        return codes, text, line, np.zeros(0, dtype=np.int64)
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    group = np.cumsum(new) - 1
    # One sort key: the line (a piece has fewer than 2 ** 24, or the plain way below), the count on a fine
    # logarithmic scale, the first bits of the code.
    scale = np.minimum(np.log2(counts[_slot(codes)] + 1.0) * 8, 255).astype(np.uint64)
    if group[-1] < 1 << 24:
        order = np.argsort((group.astype(np.uint64) << np.uint64(40)) | (scale << np.uint64(32)) | (codes >> np.uint64(32)))
        same = (codes[order][1:] >> np.uint64(32) == codes[order][:-1] >> np.uint64(32)) & (codes[order][1:] != codes[order][:-1])
    if group[-1] >= 1 << 24 or (same & (group[order][1:] == group[order][:-1])).any():
        order = np.lexsort((codes, scale, group))
    at = np.flatnonzero(new)
    codes, group = codes[order], group[order]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != codes[:-1]) | (group[1:] != group[:-1])
    codes, group = codes[keep], group[keep]
    return codes, text[at][group], line[at][group], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))


def word_counts(rows: DataFrame) -> np.ndarray:
    """Counts of hashed words, 2 ** 22 of them.  Tasks hand on tables of this size (packed, in chunks), which are added up
    ``FAN`` at a time."""
    slots = 1 << COUNT_BITS

    def pack(part):
        return zlib.compress(np.minimum(part, np.iinfo(np.uint32).max).astype(np.uint32).tobytes(), 1)

    def batch_of(cells):
        return pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()),
                                           pa.array([c[2] for c in cells], pa.binary())], names=["chunk", "part", "counts"])

    def scan(batches):
        counts = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            for low, high in _pieces(texts):
                found, n = np.unique(_slot(_words(texts[low:high])[0]).astype(np.uint32), return_counts=True)
                counts[found] += n
        at = TaskContext.get().partitionId()
        yield batch_of([(i, at, pack(part)) for i, part in enumerate(np.split(counts, CHUNKS))])

    def add(batches):
        done: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for *key, data in zip(*(c.to_pylist() for c in batch.columns)):
                done[tuple(key)] = done.get(tuple(key), 0) + np.frombuffer(zlib.decompress(data), dtype=np.uint32).astype(np.int64)
        if done:
            yield batch_of([(*key, pack(part)) for key, part in done.items()])
    schema = "chunk int, part int, counts binary"
    tables = rows.select("_text").mapInArrow(scan, schema)
    for _ in range(LEVELS):
        tables = tables.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).repartition("chunk", "part").mapInArrow(add, schema)
    out = np.zeros((CHUNKS, slots // CHUNKS), dtype=np.int64)
    for r in tables.select("chunk", "counts").collect():
        out[r["chunk"]] += np.frombuffer(zlib.decompress(r["counts"]), dtype=np.uint32)
    return np.minimum(out.reshape(-1), np.iinfo(np.uint32).max).astype(np.uint32)


def _ceil_share(n, percent: int):
    return -(-n * percent // 100)


def _line_table(rows: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """A row per line with words: where it stands, a hash and the parity bits of its set (its class), the
    set's size, and the words of its prefix that may stand elsewhere, with their places and whether their lists are
    surely short.  A task lists the words of a class once."""
    shared = rows.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 16) - 1).astype(np.uint16))

    def scan(batches):
        counts, known = shared.value, set()
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            for low, high in _pieces(texts):
                codes, text, line, starts = _line_sets(texts[low:high], counts)
                if not len(starts):
                    continue
                sizes = np.diff(np.append(starts, len(codes)))
                mixed = mix(codes + np.uint64(1))
                key = np.add.reduceat(mixed, starts).view(np.int64)
                # 128 parity bits: a word turns one of the first or one of the last 64.
                bit, last = np.uint64(1) << (mixed >> np.uint64(58)), (mixed >> np.uint64(57)) & np.uint64(1) == 1
                parity = [np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), starts).view(np.int64) for half in (~last, last)]
                place = np.arange(len(codes)) - np.repeat(starts, sizes)
                prefix = np.repeat(sizes - _ceil_share(sizes, percent) + 1, sizes)
                # Where nothing larger can match, a prefix of one word means that sets which match are equal.
                apart = (sizes * 100 // percent > sizes) | (sizes != _ceil_share(sizes, percent))
                if len(known) > REMEMBERED:
                    known = set()
                fresh = np.array([not (k in known or known.add(k)) for k in zip(key.tolist(), parity[0].tolist())])
                many = counts[_slot(codes)]
                listed = np.flatnonzero((place < prefix) & np.repeat(apart & fresh, sizes) & (many > 1))
                offsets = pa.array(np.searchsorted(listed, np.append(starts, len(codes))).astype(np.int32))
                arrays = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (
                    (codes[listed] >> np.uint64(64 - NAME_BITS)).view(np.int64), place[listed].astype(np.int32), many[listed] <= SHORT_LIST)]
                pick = pa.array(text[starts] + low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pick), batch.column("_h").take(pick), pa.array(line[starts].astype(np.int32)),
                     pa.array(key), pa.array(parity[0]), pa.array(parity[1]), pa.array(sizes.astype(np.int32)), *arrays],
                    names=["_id", "_h", "line", "key", "bits", "more", "n", "words", "places", "rare"])
    return rows.mapInArrow(scan, "_id long, _h long, line int, key long, bits long, more long, n int, words array<long>, places array<int>, rare array<boolean>")


def _spot(prefix: str = "") -> Column:
    """Where a line stands; rows without an id come last."""
    c = lambda name: F.col(prefix + name)
    return F.struct(c("_id").isNull().alias("none"), c("_id").alias("_id"), c("_h").alias("_h"), c("line").alias("line"))


def _candidates(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """``a, b``: for each class that asks in a list, its first ``most`` earlier classes there that pass all filters.

    Rows have ``w, block`` (the list, or two blocks of it), ``c`` (class), ``bits, more, n, at, side`` (of two blocks, 2 if there is
    one), whether they ``ask``, and ``after``: only later classes than that are named."""
    group, columns = ["w", "block"], ["w", "block", "c", "bits", "more", "n", "at", "side", "ask", "after"]

    def gathered(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PAIR_ROWS:
                yield {c: np.concatenate([np.asarray(b.column(c)) for b in held]) for c in columns}
                held = []
        if held:
            yield {c: np.concatenate([np.asarray(b.column(c)) for b in held]) for c in columns}

    def scan(batches):
        rest = None
        for part in gathered(batches):
            if not len(part["w"]):
                continue
            if rest is not None:
                part = {c: np.concatenate([rest[c], part[c]]) for c in columns}
            last = (part["w"] == part["w"][-1]) & (part["block"] == part["block"][-1])
            cut = int(np.argmax(last))  # the last list may go on
            rest = {c: part[c][cut:] for c in columns}
            if cut:
                yield named({c: part[c][:cut] for c in columns})
        if rest is not None:
            yield named(rest)

    def named(part):
        c, bits, more, n, at = (part[x] for x in ("c", "bits", "more", "n", "at"))
        here = np.arange(len(c))
        new = np.ones(len(c), dtype=bool)
        new[1:] = (part["w"][1:] != part["w"][:-1]) | (part["block"][1:] != part["block"][:-1])
        first = np.maximum.accumulate(np.where(new, here, 0))
        j = np.flatnonzero(part["ask"])
        x, hits = first[j], np.zeros(len(j), dtype=np.int64)
        found, side = [], part["side"]
        while True:
            live = (x < j) & (hits < most)
            j, x, hits = j[live], x[live], hits[live]
            if not len(j):
                break
            total = n[x] + n[j]
            need = -(-total * percent // (100 + percent))
            good = (n[x] * 100 >= n[j] * percent) & (n[j] * 100 >= n[x] * percent) & (np.minimum(n[x] - at[x], n[j] - at[j]) >= need)
            good &= (c[x] > part["after"][j]) & ((side[j] == 2) | (side[x] != side[j])) & (c[x] < c[j])
            k = np.flatnonzero(good)
            apart = sum(np.bitwise_count((b[x[k]] ^ b[j[k]]).view(np.uint64)).astype(np.int64) for b in (bits, more))
            k = k[apart <= (total - 2 * need)[k]]
            found.append(np.stack([c[j[k]], c[x[k]]]))
            hits[k] += 1
            x = x + 1
        cells = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=["a", "b"])
    ready = rows.select("w", "block", "c", "bits", "more", F.col("n").cast("long").alias("n"), F.col("at").cast("long").alias("at"), "side", "ask", "after")
    return ready.repartition(*group).sortWithinPartitions(*group, "c").mapInArrow(scan, "a long, b long")


def _first_named(pairs: DataFrame, most: int) -> DataFrame:
    """Over all lists, the first ``most`` candidates of each class."""
    if most == 1:
        return pairs.groupBy("a").agg(F.min("b").alias("b"))
    by = Window.partitionBy("a").orderBy("b")
    return pairs.distinct().withColumn("_n", F.row_number().over(by)).filter(F.col("_n") <= most).drop("_n")


def _line_classes(lines: DataFrame) -> DataFrame:
    """Classes of equal lines, numbered in the order of their first lines: ``c, key, bits, first, copies, more, n, words, places, rare``."""
    body = F.struct("more", "n", "words", "places", "rare")
    made = lines.groupBy("key", "bits").agg(F.min(_spot()).alias("first"), F.count("*").alias("copies"), F.max_by(body, F.size("words")).alias("_b"))
    made = made.select("key", "bits", "first", "copies", "_b.*")
    return stored(made.repartitionByRange("first").sortWithinPartitions("first").withColumn("c", F.monotonically_increasing_id()), "line-classes")


def _checked(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``a, b, ok``: whether the complete sets of two classes match."""
    met = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = classes.join(met, "c").select("first._id", "first._h", F.struct("c", "first.line").alias("x"))
    wanted = stored(wanted.groupBy("_id", "_h").agg(F.collect_list("x").alias("wanted")), "wanted-lines")
    texts = rows.join(small(wanted, BROADCAST), same_row(rows, wanted)).select(rows["_text"], "wanted")

    def fetch(batches):
        for batch in batches:
            out = []
            for t, want in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                parts = t.lower().split(b"\n")
                out += [(w["c"], np.unique(word_codes(parts[w["line"]])).view(np.int64)) for w in want]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64()))], names=["c", "set"])
    # A row that is there twice gives its sets twice.
    sets = stored(texts.mapInArrow(fetch, "c long, set array<long>").dropDuplicates(["c"]), "line-sets")
    side = lambda name, s: sets.select(F.col("c").alias(name), F.col("set").alias(s))
    both = pairs.join(small(side("a", "sa"), BROADCAST), "a").join(small(side("b", "sb"), BROADCAST), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return stored(both.select("a", "b", (common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).alias("ok")), "line-checks")


def _matched(classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``a``: the classes that match an earlier one."""
    none = F.lit(-1).cast("long")
    listed = classes.select("c", "bits", "more", "n", F.explode(F.arrays_zip("words", "places", "rare")).alias("x")).select(
        F.col("x.words").alias("w"), "c", "bits", "more", "n", F.col("x.places").alias("at"), "x.rare")
    # Lists that may be long are cut into blocks, and every two blocks meet.
    others = stored(listed.filter(~F.col("rare")).drop("rare"), "frequent-words")
    often = stored(others.groupBy("w").agg(F.count("*").alias("m")).filter("m > 1"), "word-lists")
    row = ["w", "c", "bits", "more", "n", "at"]
    alone = F.lit(2).alias("side")  # a list, or a block with itself

    def lists(of: DataFrame, often: DataFrame) -> DataFrame:
        blocks = F.ceil(F.col("m") / BLOCK).cast("long")
        cut = of.join(often, "w").withColumn("_b", F.pmod(F.xxhash64("c"), blocks).cast("long")).withColumn(
            "_o", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        meeting = (F.greatest("_b", "_o") * F.lit(1 << 31) + F.least("_b", "_o")).alias("block")
        return cut.select(*row, meeting, F.when(F.col("_b") == F.col("_o"), 2).when(F.col("_b") > F.col("_o"), 1).otherwise(0).alias("side"))
    short = listed.filter("rare").select(*row, none.alias("block"), alone)
    most = MORE
    named = _candidates(short.unionByName(lists(others, often)).select("*", none.alias("after"), F.lit(True).alias("ask")), percent, most)
    done = []
    while True:
        checks = _checked(stored(_first_named(named, most), "line-pairs"), classes, rows, percent)
        done.append(checks.filter("ok").select("a").distinct())
        # Who named as many as asked for, none of them a match, may have more.
        told = checks.groupBy("a").agg(F.count("*").alias("_n"), F.max("b").alias("after"), F.bool_or("ok").alias("_ok"))
        left = stored(told.filter((F.col("_n") >= most) & ~F.col("_ok")).select(F.col("a").alias("c"), "after"), "asking-lines")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        most *= MORE * MORE
        # Only the lists that hold one who asks.
        asked = stored(listed.join(small(left, BROADCAST), "c").select("w").distinct(), "asked-words")
        again = short.join(small(asked, BROADCAST), "w", "left_semi").unionByName(
            lists(others.join(small(asked, BROADCAST), "w", "left_semi"), often))
        again = again.join(small(left, BROADCAST), "c", "left").withColumn("ask", F.col("after").isNotNull())
        named = _candidates(again.withColumn("after", F.coalesce("after", none)), percent, most)


def duplicate_lines(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The keyed rows and ``_id, _h, lines``: the numbers of the lines to remove from each row."""
    limit_batches(docs.sparkSession)
    rows = keyed(docs, text, key)
    lines = stored(_line_table(rows, word_counts(rows), percent), "lines")
    classes = _line_classes(lines)
    matched = _matched(classes, rows, percent).select(F.col("a").alias("c"), F.lit(True).alias("_all"))
    # The first line of a class goes if the class matches an earlier one, its copies go in any case.
    marks = classes.select("c", "key", "bits", "first", "copies").join(matched, "c", "left").filter((F.col("copies") > 1) | F.col("_all"))
    marks = stored(marks.select("key", "bits", F.when(F.col("_all").isNull(), F.col("first")).alias("mark")), "line-marks")
    gone = lines.select("_id", "_h", "line", "key", "bits").join(small(marks, BROADCAST), ["key", "bits"]).filter(F.col("mark").isNull() | (_spot() > F.col("mark")))
    gone = gone.groupBy("_id", "_h").agg(F.collect_set("line").alias("lines"))
    return rows, small(stored(gone, "gone-lines"), BROADCAST)


def _kept(text: str, lines: list[int] | None) -> tuple[int, int, str]:
    parts = text.split("\n")
    gone = set(lines or ())
    return len(parts), len(gone), "\n".join(p for i, p in enumerate(parts) if i not in gone) if gone else text


def drop_repeated_lines(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id", carry: bool = False) -> DataFrame:
    """``key, n_lines, n_removed, kept`` per input row (with ``carry`` the row itself in ``row``).

    Lines end at a line feed.  A line is removed if an earlier one (by id, then line) matches it, whether that
    one stays or not.  Lines without words stay.  Null and empty texts have no line to remove.
    Rows without an id come last; rows that repeat an id and text do not remove
    from each other.  Other columns are ignored.
    """
    rows, gone = duplicate_lines(docs, percent, text, key)
    front = [F.struct("*").alias("row")] if carry else []
    own = [F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_h")]
    rows = docs.select(*front, *own) if carry else docs.select(*own, F.col(text).alias("_text"))
    names = ["row", key] if carry else [key]
    joined = rows.join(gone, same_row(rows, gone), "left").select(
        *front and ["row"], rows["_id"].alias(key), F.col(f"row.`{text}`").alias("_text") if carry else "_text", "lines")

    def scan(batches):
        for batch in batches:
            out = [(0, 0, None) if t is None else _kept(t, g) for t, g in
                   zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array([o[0] for o in out], pa.int64()),
                                              pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())],
                                             names=[*names, "n_lines", "n_removed", "kept"])
    schema = T.StructType([*(joined.schema[c] for c in names), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType())])
    return joined.mapInArrow(scan, schema)
