"""Finding benchmark passages in documents by a prefix-filtered set join, DataFrame functions only.

A benchmark item is the set of its windows (``length`` words, or the whole item if shorter), a
window the set of its placed shingles.  Shingles are ordered by how rare they are in the documents;
as a window has to be contained completely, its prefix is one shingle, the rarest.  Documents
meet windows on that shingle alone; the window must then fit between the document's ends (length
and position bounds), and its words are compared with those of the document.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ..session import size_in_bytes, small
from .common import keyed, same_row, stored

# Between words of the benchmark rule: all ASCII but digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 4
# Bytes on disk up to which a table is broadcast: of shingles alone, of numbers, and of lists and
# words, which are packed there and take many times that in memory.
SHINGLES, BROADCAST, PACKED = 32 << 20, 8 << 20, 1 << 20


def few(df: DataFrame) -> DataFrame:
    """A table with lists for a join: broadcast if it is tiny on disk, else never, whatever its estimate."""
    return F.broadcast(df) if size_in_bytes(df) <= PACKED else df.hint("merge")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain ASCII takes the faster way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), BETWEEN), lambda w: w != "")


def _shingle(codes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(codes, at + i) for i in range(size)])


def _codes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def item_windows(items: DataFrame, length: int, text: str = "text", key: str = "item_id") -> DataFrame:
    """Distinct windows ``words, size, items``: the words, how many, and the items that hold them."""
    words = items.select(F.col(key).alias("item"), words_of(F.coalesce(F.col(text), F.lit(""))).alias("w")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))).alias("at")
    windows = words.select("item", "w", at).select("item", F.slice(F.col("w"), F.col("at"), F.lit(length)).alias("words")).distinct()
    return windows.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("size", F.size("words"))


def _hits(docs: DataFrame, benchmark: DataFrame, length: int, text: str, key: str, item_text: str, item_key: str) -> DataFrame:
    """Two tables: ``_id, _h, n_words`` of every row, and ``_id, _h, n_hit, n_words, items`` of the rows that hold a window.

    Words of windows and texts stay out of what rows meet, which is numbers; no table that grows with the rows is
    broadcast beyond ``BROADCAST`` bytes."""
    items = benchmark.filter(F.col(item_key).isNotNull())
    # Numbers of windows are fixed once the table is written.
    windows = stored(item_windows(items, length, item_text, item_key).withColumn("window", F.monotonically_increasing_id()), "windows")
    placed_size = F.least("size", F.lit(SHINGLE))
    kinds = sorted(r[0] for r in windows.select(placed_size).distinct().collect())  # at most SHINGLE values
    rows = keyed(docs, text, key)
    if not kinds:
        kinds = [SHINGLE]

    # Placed shingles of the windows, and where those occur in the documents.
    spots = windows.select("window", "size", placed_size.alias("_s"), _codes(F.col("words")).alias("c"),
                           F.explode(F.sequence(F.lit(0), F.col("size") - placed_size)).alias("offset"))
    coded = F.lit(None).cast("long")
    for s in kinds:
        coded = F.when(F.col("_s") == s, _shingle(F.col("c"), F.col("offset"), s)).otherwise(coded)
    spots = stored(spots.select("window", "size", "offset", coded.alias("g")), "window-shingles")
    wanted = stored(spots.select(F.col("g").alias("_on")).distinct(), "wanted-shingles")
    split = rows.select("_id", "_h", _codes(words_of(F.col("_text"))).alias("c"))

    def placed(size: int) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size("c")), lambda i: i <= F.size("c") - size)
        return F.transform(at, lambda i: F.struct(i.alias("at"), _shingle(F.col("c"), i, size).alias("g")))
    # A row's words are counted on the same way, at a place below 0.
    counted = F.array(F.struct((-1 - F.size("c")).alias("at"), F.coalesce("_h", F.lit(0)).cast("long").alias("g")))
    grams = F.concat(counted, *[placed(s) for s in kinds])
    seen = split.select("_id", "_h", F.explode(grams).alias("x")).select("_id", "_h", "x.at", "x.g")
    seen = seen.join(small(wanted, SHINGLES), F.col("g") == F.col("_on"), "left").filter((F.col("at") < 0) | F.col("_on").isNotNull())
    seen = stored(seen.drop("_on"), "seen-shingles")
    sizes = seen.filter("at < 0").select("_id", "_h", (-1 - F.col("at")).cast("long").alias("n_words"))
    seen = seen.filter("at >= 0")

    # The rarest shingle of each window is its prefix.
    rare = seen.groupBy("g").agg(F.count("*").alias("n"))
    prefix = (spots.join(rare, "g", "left").groupBy("window", "size")
                   .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g", "offset")).alias("p"))
                   .filter("p.n > 0").select("p.g", "p.offset", "window", "size"))
    prefix = stored(prefix, "prefixes")
    starts = F.col("at") - F.col("offset")
    met = seen.join(small(prefix, BROADCAST), "g").filter(starts >= 0).select("_id", "_h", starts.alias("start"), "window", "size")
    met = stored(met.groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "window", "size")).alias("_met")), "candidates")

    # Exact words, in every row that met a window.
    asked = stored(met.select("_id", "_h"), "candidate-rows")
    texts = rows.join(small(asked, BROADCAST), same_row(rows, asked), "left_semi")
    texts = stored(texts.select("_id", "_h", words_of(F.col("_text")).alias("w")), "candidate-words")
    spans = texts.join(few(met), same_row(texts, met)).select(texts["_id"], texts["_h"], F.size("w").alias("n_words"), "w", F.explode("_met").alias("m"))
    spans = spans.filter(F.col("m.start") + F.col("m.size") <= F.col("n_words")).select(
        "_id", "_h", "n_words", "m.start", "m.window", F.slice("w", F.col("m.start") + 1, F.col("m.size")).alias("words"))
    fits = spans.join(few(windows), ["window", "words"]).select("_id", "_h", "n_words", "start", "size", "items")
    fits = fits.groupBy("_id", "_h", "n_words").agg(F.collect_set(F.struct("start", "size")).alias("_at"), F.collect_set("items").alias("_items"))
    covered = F.array_distinct(F.flatten(F.transform("_at", lambda m: F.sequence(m["start"], m["start"] + m["size"] - 1))))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("_items", lambda m: F.transform(m, lambda i: i.cast("string"))))))
    hits = fits.select("_id", "_h", F.size(covered).cast("long").alias("n_hit"), F.col("n_words").cast("long").alias("n_words"), found.alias("items"))
    return sizes, hits


def contaminated(docs: DataFrame, benchmark: DataFrame, length: int = 13, text: str = "text", key: str = "doc_id",
                 item_text: str = "text", item_key: str = "item_id", one_in: int = 20) -> DataFrame:
    """``key, n_words, n_hit, items, contaminated`` per input row.

    Words are the runs of digits, letters a-z (after lowering A-Z) and non-ASCII characters; null
    has none.  A word is hit inside any occurrence of a window; ``items`` are the sorted ids
    (as strings) of items with an occurring window.  Contaminated: a word is hit, and one word in
    ``one_in`` or more.  Items without words, or without an id, match nothing.  Repeated rows get
    equal results; other columns of both tables are ignored.
    """
    counted, hits = _hits(docs, benchmark, length, text, key, item_text, item_key)
    hits = stored(hits.drop("n_words"), "hits")
    out = counted.join(few(hits), same_row(counted, hits), "left").select(counted["*"], "n_hit", "items")
    out = out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                           "items": F.coalesce("items", F.array().cast("array<string>"))})
    return out.select(F.col("_id").alias(key), "n_words", "n_hit", "items",
                      ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = 13, text: str = "text", key: str = "doc_id",
                      item_text: str = "text", item_key: str = "item_id", one_in: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated (as above), with all their columns."""
    _, hits = _hits(docs, benchmark, length, text, key, item_text, item_key)
    bad = stored(hits.filter(F.col("n_hit") * one_in >= F.col("n_words")).select("_id", "_h"), "contaminated")
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_h"))
    return rows.join(small(bad, BROADCAST), same_row(rows, bad), "left_anti").select("_row.*")
