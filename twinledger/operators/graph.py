"""Dependency graphs: between objects (load order) and between records (closure, waves).

Each walk is a loop of joins that shrinks its working set and cuts lineage through the
shared checkpoint folder every round; only row counts come back to the driver.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, functions as F

from ..functions.text import joined
from ..session import checkpointed, forget, small, walking, written
from .ranking import number_rows
from .skew import skew_join

# Frontiers of a walk that are kept apart before they are written as one table.
FRONTS = 8


def dependency_edges(catalog: DataFrame, scope_pairs: DataFrame, all_fields: bool = False) -> DataFrame:
    """Reference fields in scope, one row per object they may point to.  A dotted scope field
    counts through its first segment, as field name or as relationship name."""
    refs = catalog.filter((F.col("type") == "reference"))
    by_field = refs.select("object", F.col("field").alias("name"), "field", "reference_to", F.lit(0).alias("_by"))
    by_relation = refs.filter(F.length("relationship_name") > 0).select(
        "object", F.col("relationship_name").alias("name"), "field", "reference_to", F.lit(1).alias("_by"))
    objects = scope_pairs.select("object").distinct()
    if all_fields:
        used = by_field.join(small(objects), "object", "left_semi").select("object", "field", "reference_to")
    else:
        wanted = scope_pairs.select("object", F.substring_index("field", ".", 1).alias("name")).distinct()
        # A direct field name hides a relationship of the same name.
        named = by_field.unionByName(by_relation).groupBy("object", "name").agg(
            F.min_by(F.struct("field", "reference_to"), F.struct("_by", "field")).alias("v"))
        plain = catalog.filter(F.col("type") != "reference").select("object", F.col("field").alias("name"))
        used = (wanted.join(named, ["object", "name"]).select("object", "name", "v.*")
                      .join(plain, ["object", "name"], "left_anti").select("object", "field", "reference_to"))
    edges = used.select("object", "field", F.explode("reference_to").alias("dependency_object")).filter(
        F.length(F.trim("dependency_object")) > 0).distinct()
    scoped = objects.select(F.col("object").alias("dependency_object"), F.lit("scoped").alias("_s"))
    return edges.join(scoped, "dependency_object", "left").select(
        "object", "field", "dependency_object", F.coalesce("_s", F.lit("external")).alias("dependency_scope"))


def _peel(nodes: DataFrame, edges: DataFrame, rank) -> tuple[DataFrame | None, DataFrame]:
    """Take off, round by round, the nodes whose dependencies are all taken.

    ``nodes`` has ``node``; ``edges`` has ``node`` and ``needs`` (both among the nodes).
    ``rank(freed, last)`` sees each round's nodes and may add columns, given the round
    before.  Returns all taken nodes with their ``level`` and the ones that never came free.
    """
    left, waiting = checkpointed(nodes), checkpointed(edges.distinct())
    taken: list[DataFrame] = []
    for level in count():
        # Every round but the last takes a node, so the walk ends.
        freed = left.join(waiting.select("node").distinct(), "node", "left_anti")
        freed = checkpointed(rank(freed.withColumn("level", F.lit(level).cast("int")), taken))
        if freed.isEmpty():
            break
        taken.append(freed)
        left = checkpointed(left.join(freed.select("node"), "node", "left_anti"))
        if left.isEmpty():
            break
        waiting = checkpointed(skew_join(waiting, freed.select(F.col("node").alias("needs")), ["needs"],
                                         "left_anti"))
    out = None
    for part in taken:
        out = part if out is None else out.unionByName(part)
    return out, left


def load_order(objects: DataFrame, edges: DataFrame, start: int = 10, step: int = 10) -> DataFrame:
    """Order objects so that each follows what it depends on: first in, first out among the
    free ones, ties by name.  Objects in or behind a cycle come last, by name.

    Inside a level the order is (position of the last dependency, name), which is what a
    first-in-first-out queue gives.
    """
    nodes = objects.select(F.col("object").alias("node")).distinct()
    inner = (edges.select(F.col("object").alias("node"), F.col("dependency_object").alias("needs"))
                  .filter(F.col("node") != F.col("needs")).distinct()
                  .join(nodes, "node", "left_semi")
                  .join(nodes.select(F.col("node").alias("needs")), "needs", "left_semi"))
    inner = checkpointed(inner)
    offset = [0]

    def place(freed: DataFrame, taken: list[DataFrame]) -> DataFrame:
        if taken:
            placed = taken[0]
            for part in taken[1:]:
                placed = placed.unionByName(part)
            last = (inner.join(placed.select(F.col("node").alias("needs"), "position"), "needs")
                         .groupBy("node").agg(F.max("position").alias("_last")))
            freed = freed.join(last, "node", "left")
        else:
            freed = freed.withColumn("_last", F.lit(0).cast("long"))
        base = sum(offset)
        return number_rows(freed, [], ["_last", "node"], "_n").select(
            "node", "level", (F.col("_n") + base).alias("position"))

    def ranked(freed: DataFrame, taken: list[DataFrame]) -> DataFrame:
        if taken:
            offset.append(taken[-1].count())
        return place(freed, taken)

    ordered, cyclic = _peel(nodes, inner, ranked)
    done = 0 if ordered is None else ordered.count()
    tail = number_rows(cyclic, [], ["node"], "_n").select(
        "node", F.lit(None).cast("int").alias("level"), (F.col("_n") + done).alias("position"))
    out = tail.withColumn("in_cycle", F.lit(True))
    if ordered is not None:
        out = ordered.withColumn("in_cycle", F.lit(False)).unionByName(out)
    return out.select(F.col("node").alias("object"), "level", "in_cycle",
                      (F.lit(start) + (F.col("position") - 1) * step).cast("int").alias("load_order"))


def review_sheet(ordered: DataFrame, edges: DataFrame, described: DataFrame | None = None) -> DataFrame:
    """The load sequence with dependency lists, review status and reason per object.
    Dependency lists and reasons name external objects as well."""
    others = edges.filter(F.col("object") != F.col("dependency_object"))
    arrow = F.concat("field", F.lit(" -> "), "dependency_object")
    listed = lambda c: joined(F.sort_array(F.collect_set(c)))
    deps = edges.groupBy("object").agg(
        listed(F.when(F.col("object") != F.col("dependency_object"), F.col("dependency_object"))).alias("dependency_objects"),
        listed(F.when((F.col("object") != F.col("dependency_object")) & (F.col("dependency_scope") == "scoped"), arrow)).alias("dependency_fields"),
        listed(F.when(F.col("object") == F.col("dependency_object"), F.col("field"))).alias("self_dependency_fields"),
        listed(F.when(F.col("dependency_scope") == "external", arrow)).alias("external_dependency_fields"))
    out = ordered.join(deps, "object", "left")
    out = out.join(described.select("object").distinct().withColumn("_d", F.lit(True)), "object", "left") \
        if described is not None else out.withColumn("_d", F.lit(True))
    blank = F.lit("")
    out = out.na.fill("", ["dependency_objects", "dependency_fields", "self_dependency_fields", "external_dependency_fields"])
    has = lambda c: F.col(c) != blank
    failed = F.col("_d").isNull()
    flags = F.concat_ws("; ", F.when(failed, "DESCRIBE_FAILED"), F.when(F.col("in_cycle"), "MANUAL_REVIEW_CYCLE"),
                        F.when(has("self_dependency_fields"), "MANUAL_REVIEW_SELF_REFERENCE"),
                        F.when(has("external_dependency_fields"), "HAS_EXTERNAL_DEPENDENCIES"))
    status = F.when(flags != blank, flags).when(has("dependency_objects"), "ORDERED_AFTER_DEPENDENCIES").otherwise("ROOT")
    sentence = lambda label, c: F.concat(F.lit(label), F.col(c), F.lit("."))
    reason = F.concat_ws(
        " ", F.when(failed, "Object describe failed; review manually."),
        F.when(has("dependency_objects"), sentence("Depends on scoped object(s): ", "dependency_objects"))
         .otherwise("No scoped object dependencies detected."),
        F.when(has("self_dependency_fields"), sentence("Self-reference field(s): ", "self_dependency_fields")),
        F.when(has("external_dependency_fields"), sentence("External reference field(s): ", "external_dependency_fields")))
    return out.select("load_order", "object", F.lit("TRUE").alias("enabled"), blank.alias("manual_override_order"),
                      "dependency_objects", "dependency_fields", "self_dependency_fields",
                      "external_dependency_fields", status.alias("dependency_status"), reason.alias("reason"), blank.alias("notes"))


def closure(start: DataFrame, edges: DataFrame, keys: tuple[str, str] = ("object", "record_id")) -> DataFrame:
    """All records reachable from ``start`` along ``edges`` (``object, record_id`` to
    ``needs_object, needs_id``), the start included.  The frontier alone is joined each round."""
    o, r = keys
    # The edges are worked out once; what was reached is a list of frontiers, put together now and then.
    edges = checkpointed(edges.select(o, r, F.col("needs_object").alias("_o"), F.col("needs_id").alias("_r")).distinct())
    frontier = checkpointed(start.select(o, r).distinct())
    seen, fronts = frontier, 1
    while True:
        step = (edges.join(frontier, [o, r], "left_semi").select(F.col("_o").alias(o), F.col("_r").alias(r)).distinct()
                     .join(seen, [o, r], "left_anti"))
        frontier = checkpointed(step)
        if frontier.isEmpty():
            return seen
        seen, fronts = seen.unionByName(frontier), fronts + 1
        if fronts % FRONTS == 0:
            seen = checkpointed(seen)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _jumped(single: DataFrame) -> DataFrame:
    """Follow chains to their ends by doubling.

    ``single`` has ``node, needs, w, base``: the level of a node is the greater of ``base`` and the level of ``needs``
    plus ``w``.  Two such steps make one of the same kind, so the way that a row covers doubles each round.
    Returns ``node, stop, w, base``, where ``stop`` is no node of ``single``; nodes in or behind a ring of such nodes
    have no end and are left out.  A chain has a node at every distance from its end, so each round closes some rows of every
    chain that is still open; once a round closes none, what is open is in or behind a ring.
    """
    known = single.select(F.col("node").alias("needs"), F.lit(True).alias("_on"))
    now = written(skew_join(single, known, ["needs"], "left").select(
        "node", F.col("needs").alias("stop"), "w", "base", F.coalesce("_on", F.lit(False)).alias("on")), "chains")
    rows, before = now.filter("on").count(), now.count()
    while rows and rows != before:
        # Rows at their end meet themselves and stay, so a round leaves one table, whose tasks follow its rows, not the rounds so far.
        ahead = now.select(F.col("node").alias("_at"), F.col("stop").alias("_s"), F.col("w").alias("_w"), F.col("base").alias("_b"), F.col("on").alias("_on"))
        step = skew_join(now.withColumn("_at", F.when(F.col("on"), F.col("stop")).otherwise(F.col("node"))), ahead.hint("merge"), ["_at"], "inner")
        jump = lambda there, here: F.when(F.col("on"), there).otherwise(F.col(here)).alias(here)
        last, now = now, written(step.select("node", jump(F.col("_s"), "stop"), jump(F.col("w") + F.col("_w"), "w"),
                                             jump(F.greatest("base", F.col("_b") + F.col("w")), "base"), jump(F.col("_on"), "on")), "chains")
        forget(last)
        rows, before = now.filter("on").count(), rows
    return now.filter(~F.col("on")).drop("on")


def levels(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, level`` of all nodes that depend on no cycle (0 without ``needs``, else one more than the highest of them),
    and the nodes in or behind one.  ``edges`` has ``node`` and ``needs``, both among the nodes.

    Nodes with one open dependency form chains, which are followed by doubling and set aside with the node at their
    end; only nodes with several are taken off round by round.  Rounds grow with the logarithm of
    chains and with the depth to which branchings follow each other, not with the length of a path.
    """
    nodes = written(nodes.select("node").distinct(), "nodes")
    every = written(edges.select("node", "needs").distinct().withColumn("w", F.lit(1).cast("long")), "open-edges")
    # Nodes with open dependencies, and the level they have by those that are met.
    waiting = state = written(every.select("node").distinct().withColumn("base", F.lit(0).cast("long")), "open-nodes")
    fresh = written(nodes.join(waiting.select("node"), "node", "left_anti").withColumn("level", F.lit(0).cast("long")), "known")
    known, aside = [fresh], []
    while True:
        counted = every.groupBy("node").agg(F.count("*").alias("_n"), F.first("needs").alias("needs"), F.first("w").alias("w"))
        single = written(counted.filter("_n = 1").drop("_n").join(waiting, "node"), "single")
        raised, done = [], [single, every, state]
        # Dependencies that may name a node whose level has been known for longer, and those that cannot.
        moved, rows = (every, every.limit(0)) if len(known) == 1 else (every.limit(0), every)
        if not single.isEmpty():
            chains = _jumped(single)
            aside.append(chains)
            ends = chains.select(F.col("node").alias("needs"), "stop", F.col("w").alias("_w"), F.col("base").alias("_b"))
            rest = written(skew_join(every.join(single.select("node"), "node", "left_anti"), ends, ["needs"], "left"), "rest")
            done.append(rest)
            went = F.col("stop").isNotNull()
            raised.append(rest.filter(went).select("node", (F.col("_b") + F.col("w")).alias("_up")))
            moved = rest.filter(went | F.lit(len(known) == 1)).select(
                "node", F.coalesce("stop", "needs").alias("needs"), (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"))
            rows = rest.filter(~went & F.lit(len(known) > 1)).select("node", "needs", "w")
            waiting = waiting.join(single.select("node"), "node", "left_anti")
        level = lambda df: df.select(F.col("node").alias("needs"), "level")
        met = written(skew_join(moved, level(_stacked(known)), ["needs"], "left").unionByName(skew_join(rows, level(fresh), ["needs"], "left")), "met")
        raised.append(met.filter(F.col("level").isNotNull()).select("node", (F.col("level") + F.col("w")).alias("_up")))
        up = _stacked(raised).groupBy("node").agg(F.max("_up").alias("_up"))
        every = written(met.filter(F.col("level").isNull()).groupBy("node", "needs").agg(F.max("w").alias("w")), "open-edges")
        state = written(waiting.join(up, "node", "left").join(every.select("node").distinct().withColumn("_open", F.lit(True)), "node", "left")
                        .select("node", F.greatest("base", F.coalesce("_up", F.lit(0))).alias("base"), F.col("_open").isNotNull().alias("_open")), "open-nodes")
        forget(met, *done)
        fresh = written(state.filter(~F.col("_open")).select("node", F.col("base").alias("level")), "known")
        waiting = state.filter("_open").drop("_open")
        if fresh.isEmpty():
            forget(every, state, fresh)
            break
        known.append(fresh)
    # The chains that were set aside last end at what is known first of all.
    for chains in reversed(aside):
        placed = skew_join(chains, _stacked(known).select(F.col("node").alias("stop"), "level"), ["stop"], "inner")
        known.append(written(placed.select("node", F.greatest("base", F.col("level") + F.col("w")).alias("level")), "known"))
        forget(chains)
    out = _stacked(known)
    return out, nodes.join(out.select("node"), "node", "left_anti")


def load_waves(records: DataFrame, edges: DataFrame) -> DataFrame:
    """Wave per record, parents first: 0 without a parent to load, else one more than the
    latest parent.  Records in or behind a cycle get a null wave and ``in_cycle``.  See :func:`levels` for the rounds,
    which see numbers instead of records."""
    with walking(records.sparkSession):
        return _waves(records, edges)


def _waves(records: DataFrame, edges: DataFrame) -> DataFrame:
    node = lambda o, r: F.struct(F.col(o).alias("object"), F.col(r).alias("record_id"))
    # A hash ahead of the name: sorting compares numbers, and names only where these are equal.
    hashed = lambda df: df.withColumn("_h", F.xxhash64("name"))
    names = written(records.select(node("object", "record_id").alias("name")).distinct().withColumn("node", F.monotonically_increasing_id()), "names")
    named = hashed(names)
    inner = skew_join(hashed(edges.select(node("object", "record_id").alias("name"), node("needs_object", "needs_id").alias("_needs"))), named, ["_h", "name"], "inner")
    half = written(inner.select("node", F.col("_needs").alias("name")), "half-numbered")
    inner = skew_join(hashed(half), named.select("_h", "name", F.col("node").alias("needs")), ["_h", "name"], "inner")
    pairs = written(inner.select("node", "needs").filter(F.col("node") != F.col("needs")).distinct(), "numbered")
    forget(half)
    done, cyclic = levels(names.select("node"), pairs)
    forget(pairs)
    out = done.select("node", F.col("level").cast("int").alias("level"), F.lit(False).alias("in_cycle")).unionByName(
        cyclic.select("node", F.lit(None).cast("int").alias("level"), F.lit(True).alias("in_cycle")))
    return out.join(names.hint("merge"), "node").select("name.*", F.col("level").alias("wave"), "in_cycle")
