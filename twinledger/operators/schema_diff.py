"""Comparison of field catalogues and selection of fields to move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..session import small

STATUS_ORDER = ["ONLY_IN_LEFT", "ONLY_IN_RIGHT", "TYPE_MISMATCH", "SAME"]

# Fields that a move never writes.
RESERVED = [
    "Id", "IsDeleted", "CreatedById", "CreatedDate", "LastModifiedById", "LastModifiedDate",
    "SystemModstamp", "LastActivityDate", "LastViewedDate", "LastReferencedDate",
    "Old_Org_Id__c", "RecordTypeId",
]

# Accepted spellings of catalogue columns, best first.
ALIASES = {
    "field": ["Field", "field", "field_name", "name"],
    "type": ["Type", "type", "source_type", "target_type"],
    "label": ["Label", "label"],
    "queryable": ["Queryable", "queryable"],
    "creatable": ["Creatable", "createable"],
    "updateable": ["Updateable", "updateable"],
}


def _one_per_field(df: DataFrame, keys: list[str]) -> DataFrame:
    order = [F.col("row_no")] if "row_no" in df.columns else []
    return df.groupBy(*keys, "field").agg(F.min_by(
        F.struct("type", "label", "queryable", "creatable", "updateable"),
        F.struct(*order, F.col("type"), F.col("label"))).alias("v")).select(*keys, "field", "v.*")


def normalised(df: DataFrame, keys: list[str]) -> DataFrame:
    """Known column spellings under one name; first row per field wins."""
    have = {c.lower(): c for c in df.columns}

    def pick(name: str, kind: str) -> Column:
        found = next((have[a.lower()] for a in ALIASES[name] if a.lower() in have), None)
        if found is None and name == "field":
            raise ValueError("no field-name column; expected one of " + ", ".join(ALIASES["field"]))
        return (F.col(f"`{found}`").cast(kind) if found else F.lit(None).cast(kind)).alias(name)

    out = df.select(*keys, strip(pick("field", "string")).alias("field"), pick("type", "string"), pick("label", "string"),
                    *[pick(n, "boolean") for n in ("queryable", "creatable", "updateable")],
                    *(["row_no"] if "row_no" in df.columns else []))
    return _one_per_field(out, keys)


def compare_schemas(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Both catalogues field by field.  A type mismatch needs both types to be known.  With
    ``keys`` (say ``["object"]``) any number of objects is compared in one pass."""
    keys = keys or []
    sides = []
    for df, tag in ((left, "left"), (right, "right")):
        n = normalised(df, keys)
        sides.append(n.select(*keys, "field", F.lit(True).alias(f"in_{tag}"), *[
            F.col(c).alias(f"{c}_{tag}") for c in ("type", "label", "queryable", "creatable", "updateable")]))
    both = sides[0].join(sides[1], [*keys, "field"], "full_outer")
    in_left, in_right = (F.coalesce(f"in_{t}", F.lit(False)) for t in ("left", "right"))
    status = (F.when(~in_right, "ONLY_IN_LEFT").when(~in_left, "ONLY_IN_RIGHT")
               .when(F.col("type_left") != F.col("type_right"), "TYPE_MISMATCH").otherwise("SAME"))
    return both.select(*keys, "field", in_left.alias("in_left"), in_right.alias("in_right"),
                       *[f"{c}_{t}" for c in ("type", "label", "queryable", "creatable", "updateable") for t in ("left", "right")],
                       status.alias("status"))


def in_status_order(df: DataFrame) -> DataFrame:
    rank = F.coalesce(*[F.when(F.col("status") == s, F.lit(i)) for i, s in enumerate(STATUS_ORDER)], F.lit(99))
    return df.orderBy(rank, "field")


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count("*").alias("row_count"))


def field_set_diff(left: DataFrame, right: DataFrame, renames: DataFrame | None = None,
                   objects: DataFrame | None = None) -> DataFrame:
    """Field names of one catalogue that the other lacks, both ways, object by object.

    ``renames`` (source_object, target_object) says which objects face each other; all
    others face their own name.  ``objects`` lists the source objects to compare (default:
    all of ``left``).  An object that a side does not know gives one row saying so.
    """
    asked = (objects if objects is not None else left).select(F.col("object").alias("source_object")).distinct()
    if renames is not None:
        asked = asked.join(small(renames), "source_object", "left")
    else:
        asked = asked.withColumn("target_object", F.lit(None).cast("string"))
    pairs = asked.withColumn("target_object", F.coalesce("target_object", "source_object"))
    l_obj = left.select(F.col("object").alias("source_object")).distinct().withColumn("_l", F.lit(True))
    r_obj = right.select(F.col("object").alias("target_object")).distinct().withColumn("_r", F.lit(True))
    pairs = pairs.join(l_obj, "source_object", "left").join(r_obj, "target_object", "left")
    none = F.lit(None).cast("string")
    absent = pairs.filter(F.col("_l").isNull() | F.col("_r").isNull()).select(
        "source_object", "target_object", none.alias("source_field"), none.alias("target_field"),
        F.when(F.col("_l").isNull(), "source_object_not_found").otherwise("target_object_not_found").alias("comparison_result"))
    known = pairs.filter(F.col("_l").isNotNull() & F.col("_r").isNotNull()).select("source_object", "target_object")
    lf = left.select(F.col("object").alias("source_object"), "field").distinct().join(known, "source_object")
    rf = right.select(F.col("object").alias("target_object"), "field").distinct().join(known, "target_object")
    key = ["source_object", "target_object", "field"]
    only_left = lf.join(rf, key, "left_anti").select(
        "source_object", "target_object", F.col("field").alias("source_field"), none.alias("target_field"),
        F.lit("missing_in_target").alias("comparison_result"))
    only_right = rf.join(lf, key, "left_anti").select(
        "source_object", "target_object", none.alias("source_field"), F.col("field").alias("target_field"),
        F.lit("missing_in_source").alias("comparison_result"))
    return absent.unionByName(only_left).unionByName(only_right)


def shared_fields(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fields both catalogues know."""
    return left.select("object", "field").intersect(right.select("object", "field"))


def is_safe_field() -> Column:
    """Over catalogue columns: a field that a move may write."""
    return ((F.coalesce(F.col("type"), F.lit("")) != "reference") & (F.col("createable") | F.col("updateable"))
            & ~F.col("calculated") & ~F.col("auto_number") & ~F.col("field").isin(*RESERVED))


def is_writable(hint: Column) -> Column:
    """Over catalogue columns: may the field be written under this operation hint."""
    return F.when(hint == "create", F.col("createable")).otherwise(F.col("updateable"))


def select_fields(source: DataFrame, target: DataFrame, restrict: DataFrame | None = None) -> DataFrame:
    """Which fields to read for a move, per object: ``Id``, writable fields, references,
    ``RecordTypeId`` — in that order — and every excluded field with its reason."""
    s = source.select("object", "field", F.col("type").alias("source_type"), F.col("queryable").alias("_queryable"),
                      F.lit(True).alias("_in_source"))
    t = target.select("object", "field", F.col("type").alias("target_type"), is_safe_field().alias("_safe"),
                      F.lit(True).alias("_in_target"))
    both = s.join(t, ["object", "field"], "full_outer")
    if restrict is not None:
        both = both.filter(F.col("_in_source")).join(small(restrict.select("field")), "field", "left_semi")
    in_s, in_t = F.coalesce("_in_source", F.lit(False)), F.coalesce("_in_target", F.lit(False))
    same = F.col("source_type").eqNullSafe(F.col("target_type"))
    ref = F.coalesce(F.col("source_type") == "reference", F.lit(False)) | F.coalesce(F.col("target_type") == "reference", F.lit(False))
    reserved = F.col("field").isin(*RESERVED)
    readable = F.coalesce("_queryable", F.lit(True))
    category = (F.when(ref & readable & same, "reference")
                 .when(~ref & readable & F.col("_safe") & same & ~reserved, "write").otherwise("excluded"))
    reason = (F.when(reserved, "reserved_field").when(ref, "reference_field_logged_only")
               .when(~readable, "not_queryable_in_source").when(~F.col("_safe"), "not_writable_in_target")
               .when(~same, "type_mismatch").otherwise("excluded_other"))
    body = both.filter(~F.col("field").isin("Id", "RecordTypeId")).select(
        "object", "field", F.when(in_s & in_t, category).otherwise("excluded").alias("category"),
        in_s.alias("in_source"), in_t.alias("in_target"),
        F.coalesce("source_type", F.lit("")).alias("source_type"), F.coalesce("target_type", F.lit("")).alias("target_type"),
        F.when(~in_s | ~in_t, "missing_in_one_org").when(category == "excluded", reason).alias("reason"))

    def fixed(name: str, category: str, needed: bool) -> DataFrame:
        one = lambda df, c: df.filter(F.col("field") == name).select("object", F.col("type").alias(c), F.lit(True).alias(f"_{c}"))
        base = source.select("object").distinct().join(one(source, "source_type"), "object", "inner" if needed else "left")
        return base.join(one(target, "target_type"), "object", "left").select(
            "object", F.lit(name).alias("field"), F.lit(category).alias("category"),
            F.coalesce("_source_type", F.lit(False)).alias("in_source"),
            F.coalesce("_target_type", F.lit(False)).alias("in_target"),
            F.coalesce("source_type", F.lit("")).alias("source_type"),
            F.coalesce("target_type", F.lit("")).alias("target_type"), F.lit(None).cast("string").alias("reason"))

    return fixed("Id", "id", False).unionByName(body).unionByName(fixed("RecordTypeId", "recordtype", True))


def selection_order() -> list[Column]:
    """Sort key of the selected fields of one object."""
    rank = F.coalesce(*[F.when(F.col("category") == c, F.lit(i)) for i, c in enumerate(
        ["id", "write", "reference", "recordtype"])], F.lit(9))
    return [rank, F.col("field")]
