"""From prepared work to operations, and from operations to a new target and results."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.payload import item, items_json
from ..functions.text import load_text
from ..model import EXTERNAL_ID, MISSING_FROM, RECORD_KEY, RESULT_COLUMNS, WORK_COLUMNS
from ..operators.deltas import actual_deltas
from ..operators.graph import load_waves
from ..operators.links import CONTACT_ROLE, Link, classify_links, route_to_link
from ..operators.ranking import number_rows
from ..operators.resolve import (FROM_EXTRACT, FROM_RUN, best_ids, create_to_update, entry_value, has_entry, id_map_from_results,
                                 known_links, natural_key_match, resolve_ids, resolve_references)
from ..operators.rules import apply_rules
from ..operators.skew import spread_join
from ..operators.state import pending
from ..operators.sample import reference_edges
from ..session import checkpointed, small, work_folder
from ..sources.result_store import keep_outcomes, stored_outcomes
from ..sources.scope import drop_foreign_sources, enabled_objects
from .prepare import key_fields

OP_COLUMNS = [*WORK_COLUMNS, "operation", "entries", "skipped", "status", "message"]

NO_KEY = "Cannot create missing record because External_Id__c is not available on the target object; the legacy id would not be preserved"
KEY_NOT_CREATEABLE = "Cannot create missing record because External_Id__c is not createable on the target object; the legacy id would not be preserved"
NOTHING_LEFT = "No writable prepared payload after relationship resolution/rules"
NO_DELTAS = "No actual deltas after target lookup; nothing written"
DRY_RUN = "Dry run only; nothing written"


def external_key(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Upserts carry their key outside the payload; creates must carry it inside.  Adds
    ``payload_error`` when a create cannot keep its legacy id."""
    out = df.join(small(key_fields(catalog)), "target_object", "left")
    without = F.filter("entries", lambda e: e["name"] != EXTERNAL_ID)
    create = (F.col("operation") == "create") & load_text(F.col("source_record_id")).isNotNull()
    there = has_entry(F.col("entries"), EXTERNAL_ID)
    error = (F.when(create & F.col("_key_known").isNull(), NO_KEY)
              .when(create & ~there & ~F.col("_key_createable"), KEY_NOT_CREATEABLE))
    with_key = F.sort_array(F.concat("entries", F.array(item(F.lit(EXTERNAL_ID), F.col("source_record_id")))))
    return (out.withColumn("payload_error", error)
               .withColumn("entries", F.when(F.col("operation") == "upsert", without)
                           .when(create & ~there & F.col("payload_error").isNull(), with_key).otherwise(F.col("entries")))
               .drop("_key_known", "_key_upsert", "_key_createable", "_key_updateable"))


def natural_key_updates(df: DataFrame, links: DataFrame, keys: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose natural key exists become updates and get their external id backfilled."""
    out = natural_key_match(df, links, keys).join(small(key_fields(catalog)), "target_object", "left")
    hit = F.col("natural_id").isNotNull()
    fill = hit & ~has_entry(F.col("entries"), EXTERNAL_ID)
    known, ok = F.col("_key_known").isNotNull(), F.coalesce("_key_updateable", F.lit(False))
    note = (F.when(~known, f"{EXTERNAL_ID}: not available to backfill after natural-key match")
             .when(~ok, f"{EXTERNAL_ID}: not updateable after natural-key match")
             .otherwise(f"{EXTERNAL_ID}: backfilled after existing target record was found by natural key"))
    return (out.withColumn("skipped", F.when(fill, F.concat("skipped", F.array(note))).otherwise(F.col("skipped")))
               .withColumn("entries", F.when(fill & ok, F.sort_array(F.concat("entries", F.array(
                   item(F.lit(EXTERNAL_ID), F.col("source_record_id")))))).otherwise(F.col("entries")))
               .withColumn("operation", F.when(hit, "update").otherwise(F.col("operation")))
               .withColumn("target_record_id", F.when(hit, F.col("natural_id")).otherwise(F.col("target_record_id")))
               .select(*df.columns))


def plan_operations(work: DataFrame, catalog: DataFrame, id_map: DataFrame | list[DataFrame], rule_table: DataFrame,
                    current: DataFrame | None = None, links: DataFrame | None = None, keys: DataFrame | None = None,
                    record_types: DataFrame | None = None, flip_creates: bool = False) -> DataFrame:
    """Decide what happens to each prepared record: ``status`` is ready, skipped (success,
    nothing to write) or failed, with a message.

    Order: references, natural key, rules, external key, actual deltas against ``current``
    (only records reported missing that turn out to be updates).
    """
    df = work.select(*WORK_COLUMNS, "operation", "entries", "skipped")
    if flip_creates:
        df = create_to_update(df, _stacked(id_map) if isinstance(id_map, list) else id_map).select(*df.columns)
    df = resolve_references(df, catalog, id_map)
    if links is not None and keys is not None:
        df = natural_key_updates(df, links, keys, catalog)
    df = apply_rules(df, rule_table, catalog, record_types)
    df = df.withColumn("_empty", F.size("entries") == 0)
    df = external_key(df, catalog)
    check = (~F.col("_empty") & F.col("payload_error").isNull() & (F.col("operation") == "update")
             & F.col("change_type").startswith(MISSING_FROM))
    if current is not None:
        df = actual_deltas(df, current, catalog, check)
    same = check & (F.size("entries") == 0)
    status = (F.when(F.col("_empty"), "skipped").when(F.col("payload_error").isNotNull(), "failed")
               .when(same, "skipped").otherwise("ready"))
    message = F.when(F.col("_empty"), NOTHING_LEFT).when(F.col("payload_error").isNotNull(), F.col("payload_error")).when(same, NO_DELTAS)
    operation = F.when(status == "skipped", "skip").otherwise(F.col("operation"))
    nothing = F.expr("array()").cast(df.schema["entries"].dataType)
    return df.select(*WORK_COLUMNS, operation.alias("operation"),
                     F.when(status == "skipped", nothing).otherwise(F.col("entries")).alias("entries"),
                     "skipped", status.alias("status"), message.alias("message"))


def batched(ops: DataFrame, size: int = 500) -> DataFrame:
    """Number ready operations into batches of at most ``size`` per object and operation."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    ready = ops.filter(F.col("status") == "ready") if "status" in ops.columns else ops
    ranked = number_rows(ready, ["target_object", "operation"], ["source_record_id"], "_rank")
    return ranked.withColumn("batch_no", F.floor((F.col("_rank") - 1) / size).cast("long")).drop("_rank")


def write_payload(ops: DataFrame) -> DataFrame:
    """What goes out per operation: an update carries the target id, an upsert its key."""
    entry = (F.when(F.col("operation") == "update", F.array(item(F.lit("Id"), F.col("target_record_id"))))
              .when(F.col("operation") == "upsert", F.array(item(F.lit(EXTERNAL_ID), F.col("source_record_id"))))
              .otherwise(F.expr("array()").cast(ops.schema["entries"].dataType)))
    return ops.withColumn("write_entries", F.sort_array(F.concat(entry, "entries")))


def default_new_id(source_id: Column) -> Column:
    return F.concat(F.lit("T"), source_id)


@dataclass(frozen=True)
class Held:
    """A target in two bucketed tables: ``rows`` (``object, record_id, external_id, values``) by record, ``keys``
    (``object, ext_id, target_id, origin``, one row each) by external id.  Joins and aggregates on these columns
    read the buckets as they are, so the target is shuffled once, when it is written."""
    rows: DataFrame
    keys: DataFrame

    def only(self, objects: list[str]) -> Held:
        """The part of some objects; buckets are sorted by object, so others are mostly skipped by the scan."""
        pick = F.col("object").isin(*objects)
        return Held(self.rows.filter(pick), self.keys.filter(pick))


def held_target(target: DataFrame) -> Held:
    """Write a target down by record and by external id, in the shared folder.  Tables are known to the session under
    names of their own and may be dropped when the result is stored."""
    spark = target.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def table(df: DataFrame, by: list[str], kind: str) -> DataFrame:
        name = f"held_{kind}_{uuid.uuid4().hex}"
        (df.repartition(buckets, *by).write.format("parquet").option("path", work_folder(spark, name)).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name))
        return spark.table(name)
    rows = table(target.select("object", "record_id", "external_id", "values"), ["object", "record_id"], "rows")
    keys = rows.filter(F.col("external_id").isNotNull()).groupBy("object", F.col("external_id").alias("ext_id")).agg(
        F.min("record_id").alias("target_id")).withColumn("origin", F.lit(FROM_EXTRACT))
    return Held(rows, table(keys, ["object", "ext_id"], "keys"))


@dataclass(frozen=True)
class Applied:
    target: DataFrame
    results: DataFrame


def outcomes(ops: DataFrame, target: DataFrame | Held, new_id=default_new_id) -> DataFrame:
    """Check each ready operation against the target and give it the id it lands on.

    ``target`` has ``object, record_id, external_id, values``, one row per record.  Updating an unknown record
    and creating an existing external id fail; an upsert updates or creates.
    """
    held_once = isinstance(target, Held)
    keys = target.keys if held_once else target.select("object", F.col("external_id").alias("ext_id"), F.col("record_id").alias("target_id"), F.lit(0).alias("origin")).dropna(subset=["ext_id"])
    target = target.rows if held_once else target
    ready, held = F.col("status") == "ready", F.col("_by_key").isNotNull()
    key = F.when(ready & (F.col("operation") == "upsert"), F.col("source_record_id")).when(
        ready & (F.col("operation") == "create"), entry_value(F.col("entries"), EXTERNAL_ID))
    df = ops.withColumn("_key", key)
    df = resolve_ids(df, keys, F.col("target_object"), F.col("_key"), "_by_key", distinct=not held_once)
    ids = target.select("object", "record_id", F.lit(True).alias("_exists"))
    df = df.withColumn("_wanted", F.when(ready & (F.col("operation") == "update"), F.col("target_record_id")))
    df = spread_join(df, ids, [F.col("target_object"), F.col("_wanted")], ["object", "record_id"], "source_record_id")
    op = F.col("operation")
    error = F.when((op == "update") & F.col("_exists").isNull(), F.to_json(F.array(F.struct(
        F.lit("ENTITY_IS_DELETED").alias("errorCode"), F.lit("target record not found").alias("message"))))).when(
        (op == "create") & held, F.to_json(F.array(F.struct(
            F.lit("DUPLICATE_VALUE").alias("errorCode"), F.concat(F.lit("duplicate value found: External_Id__c on record "), "_by_key").alias("message"),
            F.array(F.lit(EXTERNAL_ID)).alias("fields")))))
    error = F.when(ready, error)
    landed = F.when(op == "update", F.col("target_record_id")).when(op == "upsert", F.coalesce("_by_key", new_id(F.col("source_record_id")))).otherwise(
        new_id(F.col("source_record_id")))
    ok = F.when(ready, error.isNull()).otherwise(F.col("status") == "skipped")
    return df.select(
        *ops.columns, ok.alias("success"), F.when(ready & error.isNull(), landed).otherwise(F.col("target_record_id")).alias("landed_id"),
        F.coalesce(error, F.col("message"), F.lit("{}")).alias("outcome_message"), "_key")


def result_rows(checked: DataFrame, target_env: str, source_env: str, dry_run: bool) -> DataFrame:
    ready = F.col("status") == "ready"
    success = F.when(ready & F.lit(dry_run), F.lit(True)).otherwise(F.col("success"))
    return checked.select(
        F.lit(target_env).alias("target_env"), F.lit(source_env).alias("source_env"), "target_object", "source_object",
        F.coalesce("source_record_id", F.lit("")).alias("source_record_id"),
        F.coalesce(F.col("target_record_id") if dry_run else F.col("landed_id"), F.lit("")).alias("target_record_id"),
        "change_type", "operation", F.lit("TRUE" if dry_run else "FALSE").alias("dry_run"),
        F.when(success, "TRUE").otherwise("FALSE").alias("success"), F.size("entries").alias("payload_field_count"),
        items_json(F.col("entries")).alias("payload_json"), F.array_join("skipped", "; ").alias("skipped_fields"),
        (F.when(ready, DRY_RUN).otherwise(F.col("outcome_message")) if dry_run else F.col("outcome_message")).alias("message"),
    ).select(*RESULT_COLUMNS)


def merge_into(target: DataFrame, checked: DataFrame) -> DataFrame:
    """The target after all successful operations: fields are merged per record, the highest
    source id last.  Entries meet per field first, so a record that many operations write
    never gathers them."""
    tall = checked.filter((F.col("status") == "ready") & F.col("success")).select(
        F.col("target_object").alias("object"), F.col("landed_id").alias("record_id"), "source_record_id",
        F.coalesce(entry_value(F.col("entries"), EXTERNAL_ID), F.when(F.col("operation") == "upsert", F.col("source_record_id"))).alias("_ext"),
        F.explode_outer("entries").alias("e"))
    per_field = tall.groupBy("object", "record_id", F.col("e.name").alias("name")).agg(
        F.max_by("e.value", "source_record_id").alias("value"), F.max_by("_ext", F.when(F.col("_ext").isNotNull(), F.col("source_record_id"))).alias("_ext"))
    change = per_field.groupBy("object", "record_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("name").isNotNull() & (F.col("name") != EXTERNAL_ID), F.struct("name", "value")))).alias("_new"),
        F.max("_ext").alias("_ext"))
    none = F.expr("map()").cast("map<string,string>")
    both = target.join(change, ["object", "record_id"], "full_outer")
    values = F.map_zip_with(F.coalesce("values", none), F.coalesce("_new", none),
                            lambda k, a, b: F.when(F.map_contains_key(F.coalesce("_new", none), k), b).otherwise(a))
    return both.select("object", "record_id", F.coalesce("_ext", "external_id").alias("external_id"), values.alias("values"))


def apply_operations(target: DataFrame | Held, ops: DataFrame, target_env: str = "new", source_env: str = "old",
                     dry_run: bool = False, new_id=default_new_id) -> Applied:
    """Operations applied to a target: its new state and a result row per operation.  A target that is used
    more than once is best given as :func:`held_target`."""
    checked = outcomes(ops, target, new_id)
    rows = target.rows if isinstance(target, Held) else target
    return Applied(rows if dry_run else merge_into(rows, checked), result_rows(checked, target_env, source_env, dry_run))


def _links_of(target: DataFrame, link: Link) -> DataFrame:
    """The link rows that the target holds, as link operators want them."""
    value = lambda name: load_text(F.try_element_at("values", F.lit(name)))
    return target.filter(F.col("object") == link.object).select(
        value(link.parent_field).alias("parent_id"), value(link.child_field).alias("child_id"), F.col("record_id").alias("link_id"),
        (F.lower(value(link.flag_field)) == "true").alias("is_primary"), "values").dropna(subset=["parent_id", "child_id"])


def load_links(work: DataFrame, target: DataFrame, catalog: DataFrame, id_map: DataFrame, rule_table: DataFrame, link: Link,
               new_id=default_new_id) -> DataFrame:
    """Checked operations on a link object: its own deltas, then what parents name in a field that
    is routed.  ``id_map`` knows the parents and children of this run.  Creates come ahead of
    the updates, which may name a row that was just made."""
    none = F.expr("map()").cast("map<string,string>")

    def applied(ops: DataFrame, known: DataFrame) -> DataFrame:
        made = checkpointed(outcomes(ops.filter(F.col("operation") != "update"), known, new_id))
        fresh = made.filter(F.col("success") & (F.col("status") == "ready")).select(
            F.col("target_object").alias("object"), F.col("landed_id").alias("record_id"), F.lit(None).cast("string").alias("external_id"), none.alias("values"))
        return made.unionByName(outcomes(ops.filter(F.col("operation") == "update"), known.unionByName(fresh), new_id))

    held = checkpointed(_links_of(target, link))
    known = checkpointed(target.filter(F.col("object") == link.object))
    own = checkpointed(applied(classify_links(work, id_map, held, catalog, rule_table, link, new_id), known))
    made = own.filter((F.col("operation") == "create") & F.col("success") & (F.col("status") == "ready"))
    value = lambda name: load_text(entry_value(F.col("entries"), name))
    made = made.select(value(link.parent_field).alias("parent_id"), value(link.child_field).alias("child_id"), F.col("landed_id").alias("link_id"),
                       (F.coalesce(F.lower(value(link.flag_field)), F.lit("")) == "true").alias("is_primary"), none.alias("values"))
    fresh = made.select(F.lit(link.object).alias("object"), F.col("link_id").alias("record_id"), F.lit(None).cast("string").alias("external_id"), "values")
    routed = route_to_link(work, id_map, held.unionByName(made), link)
    return own.unionByName(applied(routed.select(*own.columns[:len(routed.columns)]), known.unionByName(fresh)))


def run_load(work: DataFrame, target: DataFrame | Held, catalog: DataFrame, rule_table: DataFrame,
             links: DataFrame | None = None, keys: DataFrame | None = None, record_types: DataFrame | None = None,
             target_env: str = "new", source_env: str = "old", dry_run: bool = False, new_id=default_new_id,
             results: DataFrame | None = None, retry_failed: bool = False, link: Link | None = CONTACT_ROLE,
             sequence: DataFrame | None = None, policy: DataFrame | None = None, only: DataFrame | None = None, store: str | None = None) -> Applied:
    """Load prepared work parents first, so that a child finds the id its parent got.

    One pass per wave plans that wave's records with the ids of all earlier waves; the target is written down by record
    and by key once, and a wave reads the buckets of its objects; it is merged once, at the end.  Records in a
    reference cycle go last, together, and the link object after them: its own deltas and the fields
    that are routed to it.  Objects with a natural key (``keys``, with ``links`` or else the target's own rows) are
    matched by it.  Records that ``results`` already hold are left out, failed ones included unless ``retry_failed``.

    ``sequence`` (see ``scope``) restricts the load to its enabled objects, ``only`` to a list, and ``policy`` leaves out objects
    that must come from another source.  With ``store`` each wave's results are kept there as it ends
    (``result_store``), and a later call takes up what is left.
    """
    if sequence is not None:
        objects = enabled_objects(sequence, only)
        objects = drop_foreign_sources(objects, policy, source_env) if policy is not None else objects
        work = work.join(small(objects.select(F.col("object").alias("target_object"))), "target_object", "left_semi")
    if store is not None:
        kept = stored_outcomes(work.sparkSession, store)
        results = kept if results is None else results.unionByName(kept, allowMissingColumns=True)
    held = target if isinstance(target, Held) else held_target(target)
    earlier = None
    if results is not None:
        earlier = checkpointed(best_ids(id_map_from_results(results)))
        work = pending(work, results, retry_failed)
    if keys is not None and links is None:
        links = known_links(held.rows, keys)
    work = checkpointed(work)
    mine = work.filter(F.col("target_object") != link.object) if link else work
    objects = mine.select(F.col("target_object").alias("object")).distinct()
    before = held.keys if earlier is None else held.keys.unionByName(earlier)
    edges = reference_edges(mine, catalog, objects, before)
    nodes = mine.select(F.col("target_object").alias("object"), F.col("source_record_id").alias("record_id"))
    waves = load_waves(nodes, edges).select(F.col("object").alias("target_object"), F.col("record_id").alias("source_record_id"),
                                            F.coalesce("wave", F.lit(1 << 30)).alias("wave"))
    placed = checkpointed(mine.join(waves, RECORD_KEY))
    plan: dict[int, list[str]] = {}
    for r in placed.select("wave", "target_object").distinct().collect():  # objects per wave, not records
        plan.setdefault(r.wave, []).append(r.target_object)
    done, fresh = [], [] if earlier is None else [earlier]
    for wave in sorted(plan):
        part = held.only(plan[wave])
        maps = [held.keys, *([best_ids(_stacked(fresh))] if fresh else [])]
        ops = plan_operations(placed.filter(F.col("wave") == wave), catalog, maps, rule_table,
                              current=part.rows, links=links, keys=keys, record_types=record_types)
        checked = checkpointed(outcomes(ops, part, new_id))
        done.append(checked)
        if store is not None and not dry_run:
            keep_outcomes(result_rows(checked, target_env, source_env, False), store)
        fresh.append(checked.filter(F.col("success") & load_text(F.col("landed_id")).isNotNull()).select(
            F.col("target_object").alias("object"), F.col("source_record_id").alias("ext_id"),
            F.col("landed_id").alias("target_id"), F.lit(FROM_RUN).alias("origin")))
    if link is not None:
        routed = checkpointed(load_links(work, held.rows, catalog, _stacked([held.keys, *fresh]), rule_table, link, new_id))
        if store is not None and not dry_run:
            keep_outcomes(result_rows(routed, target_env, source_env, False), store)
        done.append(routed)
    if not done:
        raise ValueError("there is no work to load")
    every = _stacked(done)
    return Applied(held.rows if dry_run else merge_into(held.rows, every), result_rows(every, target_env, source_env, dry_run))


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def target_state(long_df: DataFrame) -> DataFrame:
    """A long extract of the target as ``object, record_id, external_id, values``."""
    seq = F.col("seq").cast("long") if "seq" in long_df.columns else F.lit(0).cast("long")
    keyed = long_df.select(F.col("obj").alias("object"), "record_id", "external_id", "field", "value", seq.alias("seq")).repartition("object", "record_id")
    per_field = keyed.groupBy("object", "record_id", "field").agg(
        F.max(F.struct("seq", "value")).alias("last"), F.min(F.struct("seq", "external_id")).alias("first"))
    return per_field.groupBy("object", "record_id").agg(
        F.min("first")["external_id"].alias("external_id"),
        F.map_from_entries(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", F.col("last.value"))))).alias("values"))
