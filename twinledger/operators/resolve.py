"""Looking up target record ids: by external id, by ordered reference, by natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import load_text, strip
from ..model import EXTERNAL_ID, RECORD_KEY, rows
from ..session import config, small
from .skew import skew_join, spread_join

# Where a target id came from; the lowest found for an object wins.
FROM_RUN, FROM_EXTRACT, FROM_LOOKUP = 0, 1, 2


def id_map_from_extract(long_df: DataFrame, origin: int = FROM_EXTRACT) -> DataFrame:
    """``(object, ext_id) -> target_id`` of a target extract; the first record seen wins,
    first meaning lowest ``seq``, then lowest id."""
    seq = F.col("seq").cast("long") if "seq" in long_df.columns else F.lit(0).cast("long")
    ids = long_df.select(F.col("obj").alias("object"), load_text(F.col("external_id")).alias("ext_id"),
                         load_text(F.col("record_id")).alias("target_id"), seq.alias("seq")).dropna(
        subset=["object", "ext_id", "target_id"])
    return ids.groupBy("object", "ext_id").agg(F.min_by("target_id", F.struct("seq", "target_id")).alias("target_id")) \
              .withColumn("origin", F.lit(origin))


def id_map_from_results(results: DataFrame) -> DataFrame:
    """Ids of records loaded successfully before, which come ahead of any extract.  The last
    result of a record counts."""
    ids = results.filter(F.upper("success") == "TRUE").select(
        load_text(F.col("target_object")).alias("object"), load_text(F.col("source_record_id")).alias("ext_id"),
        load_text(F.col("target_record_id")).alias("target_id"),
        (F.col("seq") if "seq" in results.columns else F.lit(0)).cast("long").alias("seq")).dropna(
        subset=["object", "ext_id", "target_id"])
    return ids.groupBy("object", "ext_id").agg(F.max_by("target_id", F.struct("seq", "target_id")).alias("target_id")) \
              .withColumn("origin", F.lit(FROM_RUN))


def best_ids(id_map: DataFrame) -> DataFrame:
    """One id per (object, external id) when several maps are stacked."""
    return id_map.groupBy("object", "ext_id").agg(
        F.min_by("target_id", F.struct("origin", "target_id")).alias("target_id"), F.min("origin").alias("origin"))


def resolve_ids(df: DataFrame, id_map: DataFrame, object_col: Column, ext_col: Column, name: str, distinct: bool = True) -> DataFrame:
    """Add ``name``: the target id of each row's (object, external id), or null.  Parents
    that a great many rows point to are split at run time.  A map that has one row per key already is not
    aggregated with ``distinct`` False."""
    ids = best_ids(id_map) if distinct else id_map
    ids = ids.select(F.col("object").alias("_o"), F.col("ext_id").alias("_e"), F.col("target_id").alias(name))
    keyed = df.withColumn("_asked", load_text(ext_col))
    return spread_join(keyed, ids, [object_col, F.col("_asked")], ["_o", "_e"], "source_record_id").drop("_asked")


def create_to_update(work: DataFrame, id_map: DataFrame) -> DataFrame:
    """Rows without a target id whose external id already exists in the target become
    updates of that record."""
    found = resolve_ids(work, id_map, F.col("target_object"), F.col("source_record_id"), "_found")
    flip = load_text(F.col("target_record_id")).isNull() & F.col("_found").isNotNull()
    return (found.withColumn("operation", F.when(flip, "update").otherwise(F.col("operation")))
                 .withColumn("target_record_id", F.when(flip, F.col("_found")).otherwise(F.col("target_record_id")))
                 .drop("_found"))


def reference_fields(catalog: DataFrame) -> DataFrame:
    return (config(catalog).filter(F.length("relationship_name") > 0)
            .groupBy(F.col("object").alias("target_object"), F.col("relationship_name").alias("name"))
            .agg(F.max_by(F.struct("field", "nillable", "reference_to"), "field").alias("meta"))
            .select("target_object", "name", "meta.*"))


def resolve_references(prepared: DataFrame, catalog: DataFrame, id_map: DataFrame | list[DataFrame]) -> DataFrame:
    """Replace reference entries by the target id of the record they name.

    The objects a reference may point to are tried in their order, and per object the ids of
    this run before those of the extract before looked-up ones: the first hit wins.  A blank
    key clears the field if it may be empty; a miss drops the entry and says so.
    ``prepared`` has one row per record with ``entries`` and ``skipped``.  ``id_map`` may be a list of maps that hold one
    row per (object, external id); each is joined as it is partitioned.

    Records are read once: each travels as a row of its own beside the ids its references ask for, and both meet again
    by record.
    """
    packed = reference_fields(catalog).groupBy("target_object").agg(F.map_from_entries(F.collect_list(F.struct(
        "name", F.struct("field", "nillable", "reference_to")))).alias("_refs"))
    known = small(packed)
    is_ref = lambda e: (e["ext_field"] == EXTERNAL_ID) & F.coalesce(F.map_contains_key("_refs", e["name"]), F.lit(False))
    asked = F.filter("entries", lambda e: is_ref(e) & load_text(e["value"]).isNotNull())
    tries = F.flatten(F.transform(asked, lambda e: F.transform(F.element_at("_refs", e["name"])["reference_to"], lambda o, i: F.struct(
        e["name"].alias("name"), i.alias("pos"), o.alias("object"), load_text(e["value"]).alias("ext_id")))))
    # The record's own row asks for nothing; its key keeps such rows apart from each other.
    own = F.struct(F.lit(None).cast("string").alias("name"), F.lit(-1).alias("pos"), F.lit("\0").alias("object"), F.coalesce("source_record_id", F.lit("")).alias("ext_id"))
    rows = prepared.join(known, "target_object", "left").withColumn("_try", F.explode(F.concat(F.array(own), F.coalesce(tries, F.array().cast(
        "array<struct<name:string,pos:int,object:string,ext_id:string>>")))))
    rows = rows.select(*RECORD_KEY, F.when(F.col("_try.pos") < 0, F.struct(*prepared.columns)).alias("_record"), "_try.*")
    found = []
    for i, ids in enumerate(id_map if isinstance(id_map, list) else [best_ids(id_map)]):
        rows = skew_join(rows, ids.select("object", "ext_id", F.struct("origin", "target_id").alias(f"_hit{i}")), ["object", "ext_id"], "left")
        found.append(F.col(f"_hit{i}"))
    best = F.least(*found) if len(found) > 1 else found[0]
    met = rows.groupBy(*RECORD_KEY).agg(
        F.collect_list("_record").alias("_records"),
        F.collect_list(F.when(best.isNotNull(), F.struct("name", "pos", best.alias("hit")))).alias("_hits"))
    out = met.select("_hits", F.explode("_records").alias("_record")).select("_record.*", "_hits").join(known, "target_object", "left")
    # Name, resolved field and value, and the reason when there is none.
    judged = F.transform(F.filter("entries", is_ref), lambda e: F.struct(
        e["name"].alias("name"), load_text(e["value"]).alias("ext_id"), F.element_at("_refs", e["name"]).alias("meta"),
        F.array_min(F.filter("_hits", lambda h: h["name"] == e["name"]))["hit"]["target_id"].alias("target_id")))
    out = out.withColumn("_judged", F.coalesce(judged, F.expr("array()")))

    def note(r):
        where = F.coalesce(F.nullif(F.array_join(r["meta"]["reference_to"], "; "), F.lit("")), F.lit("reference object"))
        return (F.when(r["ext_id"].isNull(), F.when(~r["meta"]["nillable"], F.concat(r["name"], F.lit(f".{EXTERNAL_ID}: blank required relationship"))))
                 .when(r["target_id"].isNull(), F.concat(r["name"], F.lit(f".{EXTERNAL_ID}="), r["ext_id"], F.lit(": related record not found in "), where)))
    keep = lambda r: F.when(r["ext_id"].isNull(), r["meta"]["nillable"]).otherwise(r["target_id"].isNotNull())
    new = F.transform(F.filter("_judged", keep), lambda r: F.struct(
        r["meta"]["field"].alias("name"), F.lit(None).cast("string").alias("ext_field"), r["target_id"].alias("value")))
    out = out.withColumn("_new", new).withColumn("_named", F.transform("_new", lambda e: e["name"]))
    # A resolved field replaces a plain entry of the same name.
    rest = F.filter("entries", lambda e: ~is_ref(e) & (e["ext_field"].isNotNull() | ~F.array_contains("_named", e["name"])))
    notes = F.sort_array(F.array_compact(F.transform("_judged", note)))
    some = F.size("_judged") > 0
    return out.select(*[(F.when(some, F.sort_array(F.concat(rest, "_new"))).otherwise(F.col("entries")) if c == "entries" else
                         F.when(some, F.concat("skipped", notes)).otherwise(F.col("skipped")) if c == "skipped" else F.col(f"`{c}`")).alias(c)
                        for c in prepared.columns])


def entry_value(entries: Column, name: str | Column) -> Column:
    """Value of a plain payload entry, null when absent."""
    return F.get(F.filter(entries, lambda e: (e["name"] == name) & e["ext_field"].isNull()), F.lit(0))["value"]


def has_entry(entries: Column, name: str | Column) -> Column:
    return F.exists(entries, lambda e: e["name"] == name)


# Objects known by the records they link, and the payload fields of that key.  The third
# only narrows where a payload has it.
NATURAL_KEY_COLUMNS = ["target_object", "key_1", "key_2", "key_3"]
NATURAL_KEYS = [
    ("AccountContactRelation", "AccountId", "ContactId", None),
    ("OpportunityContactRole", "OpportunityId", "ContactId", None),
    ("Account_Relationship__c", "Main_Account__c", "Secondary_Account__c", "Secondary_Party_Type__c"),
]


def default_natural_keys(spark: SparkSession) -> DataFrame:
    return rows(spark, NATURAL_KEY_COLUMNS, NATURAL_KEYS, ", ".join(f"{c} string" for c in NATURAL_KEY_COLUMNS))


def known_links(target: DataFrame, keys: DataFrame) -> DataFrame:
    """The target's rows of objects with a natural key, by that key: ``target_object, k1, k2, k3, target_id``."""
    named = target.withColumnRenamed("object", "target_object").join(small(keys), "target_object")
    value = lambda c: load_text(F.try_element_at("values", F.col(c)))
    return named.select("target_object", value("key_1").alias("k1"), value("key_2").alias("k2"), value("key_3").alias("k3"),
                        F.col("record_id").alias("target_id")).dropna(subset=["k1", "k2"])


def natural_key_match(df: DataFrame, links: DataFrame, keys: DataFrame) -> DataFrame:
    """Find existing link rows by their natural key.

    ``keys`` configures each object: ``target_object, key_1, key_2, key_3`` (payload field
    names; the third is optional and only narrows when the payload has a value for it).
    ``links`` lists existing rows: ``target_object, k1, k2, k3, target_id``.  Adds
    ``natural_id`` (the lowest matching id, for a repeatable choice).
    """
    out = df.join(small(keys.select("target_object", "key_1", "key_2", "key_3")), "target_object", "left")
    values = [load_text(entry_value(F.col("entries"), F.col(f"key_{i}"))) for i in (1, 2, 3)]
    for i, v in enumerate(values, 1):
        out = out.withColumn(f"k{i}", F.when(F.col(f"key_{i}").isNotNull(), v))
    exact = links.filter(F.col("k3").isNotNull()).groupBy("target_object", "k1", "k2", "k3").agg(F.min("target_id").alias("_exact"))
    loose = links.groupBy("target_object", "k1", "k2").agg(F.min("target_id").alias("_loose"))
    out = skew_join(out, exact, ["target_object", "k1", "k2", "k3"], "left")
    out = skew_join(out, loose, ["target_object", "k1", "k2"], "left")
    return (out.withColumn("natural_id", F.when(F.col("k3").isNotNull(), F.col("_exact")).otherwise(F.col("_loose")))
               .drop("key_1", "key_2", "key_3", "k1", "k2", "k3", "_exact", "_loose"))


def active_ids(types: DataFrame) -> DataFrame:
    """Developer name to id: the last active row of a name, else its first row.

    ``types`` has ``object, developer_name, id, is_active`` and optionally ``row_no``."""
    order = F.col("row_no") if "row_no" in types.columns else F.lit(0)
    active = F.coalesce(F.col("is_active"), F.lit(True))
    pick = F.coalesce(F.max_by(F.when(active, F.col("id")), F.when(active, F.struct(order, F.col("id")))),
                      F.min_by("id", F.struct(order, F.col("id"))))
    return types.groupBy("object", "developer_name").agg(pick.alias("id"))


def point_fetch(work: DataFrame, wanted: DataFrame) -> DataFrame:
    """The work rows of the wanted (object, source id) pairs, in one join."""
    ids = wanted.select(F.col("object").alias("target_object"), strip(F.col("record_id")).alias("source_record_id")).distinct()
    return work.join(ids, RECORD_KEY, "left_semi")
