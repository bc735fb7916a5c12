"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source; targets follow from the weights by water filling; each source's
documents form blocks in a permuted order, and its target becomes a quota of block draws, turns that go
round over this order until the target is met.  A splitting tree deals the quotas to
output shards: at every node a random half of the node's draws goes left, which splits the
source counts by a multivariate hypergeometric law.  Shards then take disjoint runs of each
source's turns, and a hash orders the documents inside a shard.  What is taken of a document are the draws
of its block that the shards hold; the last turn of a source may be of part of a block.

Only tables of one row per source or block are joined to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import small
from .common import WORD, stored

SEED = "mix"


def _draw(*parts) -> Column:
    """A fixed pseudo-random key for the given values."""
    return F.md5(F.concat_ws("|", F.lit(SEED), *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("<null>"))
                                                for p in parts]))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``: the total is shared by
    weight; a target stops at ``most`` times its source's size and the excess is shared again.

    Weights go round over the sources by code point, null last.  With sources by size over weight, the
    level when the first k have stopped is (total - their caps) / (weights left); the largest
    of these levels is the one at which nothing is above its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_r", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_r") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * most)
    stops = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), F.col("_r").asc())
    everything = Window.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(stops.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(everything) - before("_cap")) / (F.sum("weight").over(everything) - before("weight"))
    level = ranked.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
    target = F.least(F.col("_cap").cast("double"), F.col("weight") * F.col("_level"))
    return level.withColumn("target", target).select(*sizes.columns, "weight", "target")


def split_quotas(quotas: DataFrame, levels: int) -> DataFrame:
    """``shard, _s, quota`` from ``_s, quota`` (a source's tag): quotas of block draws dealt to 2 ** levels shards
    whose totals differ by one at most."""
    nodes = quotas.select(F.lit(0).alias("shard"), "_s", "quota")
    for level in range(levels):
        draws = nodes.filter("quota > 0").select("shard", "_s", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("_i"))
        node = Window.partitionBy("shard")
        side = F.when(F.row_number().over(node.orderBy(_draw(F.lit(level), "shard", "_s", "_i"))) * 2
                      <= F.count("*").over(node) + F.col("shard") % 2, 0).otherwise(1)
        nodes = draws.select((F.col("shard") * 2 + side).alias("shard"), "_s").groupBy("shard", "_s").agg(F.count("*").alias("quota"))
    return nodes


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, levels: int = 4,
                text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: ``key, source, size, source_size, target, taken`` and ``places``, the output shard
    and the order in it of every copy taken (array of ``copy, shard, order``).

    Size is the number of words (null text: 0).  A document is taken whole, once for every draw of its block that a
    shard holds; of a source's last block only what lies ahead of the cut, and one document of each source to fit
    the gap that is left.  Nothing is taken more than ``most`` times.  Rows of equal id and size share their fate; a null source is a source of its own; documents without words
    are taken 0 words.  Everything follows from the ids: reruns agree.
    """
    tag = F.when(F.col(source).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source)))
    sized = stored(docs.select(F.col(key).alias("_id"), F.col(source).alias("source"), tag.alias("_s"),
                               F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
                       .withColumn("_key", _draw("_id", "size"))
                       .withColumn("_block", F.substring("_key", 1, 2)).withColumn("_part", F.substring("_key", 3, 2)), "mix-sizes")
    sizes = sized.groupBy("source", "_s").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "mix-targets")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    targets = targets.withColumn("_full", full).withColumn("_rest", F.col("target") - F.col("_full") * F.col("source_size"))

    # The cut: the block it falls into, then the part of that block, then the document.
    ahead = Window.unboundedPreceding, -1
    sums = lambda order: F.coalesce(F.sum("_words").over(Window.partitionBy("_s").orderBy(order).rowsBetween(*ahead)), F.lit(0))
    state = F.when(F.col("_before") + F.col("_words") <= F.col("_rest"), "all").when(F.col("_before") >= F.col("_rest"), "none").otherwise("cut")
    turns = Window.partitionBy("_s").orderBy(_draw("source", "_block"))
    blocks = sized.groupBy("_s", "source", "_block").agg(F.sum("size").alias("_words")).withColumn("_before", sums(_draw("source", "_block")))
    blocks = blocks.withColumn("_index", F.row_number().over(turns)).withColumn("_blocks", F.count("*").over(Window.partitionBy("_s")))
    blocks = stored(blocks.join(small(targets.drop("source")), "_s").withColumn("_state", state), "mix-blocks")
    cut = blocks.filter("_state = 'cut'").select("_s", "_block", "_before", "_rest")
    within = sized.join(small(cut), ["_s", "_block"])
    parts = within.groupBy("_s", "_block", "_part", "_before", "_rest").agg(F.sum("size").alias("_words"))
    parts = stored(parts.withColumn("_before", F.col("_before") + sums(F.col("_part"))).withColumn("_inside", state), "mix-parts")
    last = parts.filter("_inside = 'cut'").select("_s", "_block", "_part", "_before", "_rest")
    tail = sized.join(small(last), ["_s", "_block", "_part"]).groupBy("_s", "_key", "_before", "_rest").agg(F.sum("size").alias("_words"))
    ends = tail.withColumn("_before", F.col("_before") + sums(F.col("_key"))).filter(F.col("_before") + F.col("_words") > F.col("_rest"))
    ends = ends.groupBy("_s").agg(F.min("_key").alias("_stop"))
    # The first part that is not taken as a whole.
    edges = parts.filter("_inside <> 'all'").groupBy("_s").agg(F.min(F.struct("_part", "_inside")).alias("_edge"))

    # Quotas of block draws, dealt to the shards; a shard's run of turns names blocks and copies.
    quotas = blocks.groupBy("_s").agg(F.sum(F.col("_full") + F.when(F.col("_state") == "none", 0).otherwise(1)).alias("quota"))
    shards = split_quotas(quotas, levels)
    runs = shards.select("_s", "shard", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("_i"))
    runs = runs.withColumn("_turn", F.row_number().over(Window.partitionBy("_s").orderBy("shard", "_i")) - 1).drop("_i")
    order = blocks.select("_s", "_block", "_index", "_blocks")
    drawn = runs.join(small(order.select("_s", "_blocks").distinct()), "_s").select(
        "_s", "shard", (F.col("_turn") % F.col("_blocks") + 1).cast("int").alias("_index"),
        (F.floor(F.col("_turn") / F.col("_blocks")) + 1).cast("int").alias("copy"))
    dealt = drawn.join(order, ["_s", "_index"]).groupBy("_s", "_block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("_draws"))
    plan = blocks.select("_s", "_block", "source_size", "target", "_full", "_state").join(dealt, ["_s", "_block"], "left")
    plan = stored(plan.join(edges, "_s", "left").join(ends, "_s", "left"), "mix-plan")

    out = sized.join(small(plan), ["_s", "_block"])
    # Parts ahead of the edge are in, later ones out; in it, documents ahead of the stop are in.
    beyond = F.lit("g")
    inside = (F.col("_part") < F.col("_edge._part")) | (
        (F.col("_part") == F.col("_edge._part")) & (F.col("_edge._inside") == "cut") & (F.col("_key") < F.coalesce("_stop", beyond)))
    none = F.array().cast("array<struct<copy:int,shard:int>>")
    held = F.size(F.coalesce("_draws", none)) - F.when((F.col("_state") == "cut") & ~F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    out = out.withColumn("_held", held)

    # What is still missing goes to the document whose size fits the gap best.
    gaps = out.groupBy("_s").agg(F.sum(F.col("size") * (F.col("_held") - F.col("_full"))).alias("_in")).join(small(targets.select("_s", "_rest")), "_s")
    gaps = stored(gaps.select("_s", (F.col("_rest") - F.col("_in")).alias("_gap")), "mix-gaps")
    left = out.filter((F.col("_held") == F.col("_full")) & (F.col("size") > 0)).select("_s", "_key", "size").join(small(gaps), "_s")
    misses = F.abs(F.col("_gap") - F.col("size"))
    fits = left.filter(misses < F.col("_gap")).groupBy("_s").agg(F.min(F.struct(misses.alias("d"), "_key")).alias("_fit"))
    out = out.join(small(stored(fits.select("_s", F.col("_fit._key").alias("_fit")), "mix-fits")), "_s", "left")
    copies = F.col("_held") + F.when(F.col("_key") == F.col("_fit"), 1).otherwise(0)
    place = lambda copy, shard: F.struct(copy.alias("copy"), shard.cast("int").alias("shard"),
                                         F.xxhash64(shard.cast("int"), F.col("_key"), copy).alias("order"))
    placed = F.transform(F.filter(F.coalesce("_draws", none), lambda d: d["copy"] <= copies),
                         lambda d: place(d["copy"], d["shard"]))
    # The fitted document's block may have no draw for its last copy.
    alone = F.array(place(copies, F.conv(F.substring("_key", 5, 4), 16, 10).cast("int") % (1 << levels)))
    placed = F.when((copies > 0) & ~F.exists(placed, lambda d: d["copy"] == copies), F.concat(placed, alone)).otherwise(placed)
    return out.select(F.col("_id").alias(key), F.col("source").alias(source), "size", "source_size", "target",
                      (F.col("size") * copies).alias("taken"), placed.alias("places"))
