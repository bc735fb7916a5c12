"""Record payloads: maps from field to text, and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAP = "map<string,string>"


def empty() -> Column:
    return F.from_json(F.lit("{}"), MAP)


def sorted_map(m: Column) -> Column:
    return F.map_from_entries(F.sort_array(F.map_entries(m)))


def to_text(m: Column) -> Column:
    """JSON with sorted keys; null entries are kept."""
    return F.to_json(sorted_map(m))


def parse(c: Column) -> Column:
    """JSON object to map; blank text is an empty map, anything else that is not an object
    gives null (see :func:`is_malformed`)."""
    from .text import load_text
    text = load_text(c)
    return F.when(text.isNull(), empty()).otherwise(F.from_json(text, MAP))


def parse_list(c: Column) -> Column:
    from .text import load_text
    text = load_text(c)
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.from_json(text, "array<string>"))


def is_malformed(c: Column) -> Column:
    """Text is present but is no JSON object."""
    from .text import load_text
    v = F.try_parse_json(load_text(c))
    return load_text(c).isNotNull() & (v.isNull() | ~F.coalesce(F.schema_of_variant(v), F.lit("")).startswith("OBJECT"))


def merged(load_only: Column, diff: Column) -> Column:
    """Load-only fields under the diff fields; a diff field wins even when it is null."""
    return F.map_zip_with(F.coalesce(load_only, empty()), F.coalesce(diff, empty()),
                          lambda k, a, b: F.when(F.map_contains_key(diff, k), b).otherwise(a))


def key_list(c: Column) -> Column:
    """Sorted field names of a JSON object, ``; `` joined; empty for anything else."""
    return F.coalesce(F.array_join(F.sort_array(F.map_keys(F.from_json(c, MAP))), "; "), F.lit(""))


def item(name: Column, value: Column, ext_field: Column | None = None) -> Column:
    ext = F.lit(None).cast("string") if ext_field is None else ext_field
    return F.struct(name.alias("name"), ext.alias("ext_field"), value.cast("string").alias("value"))


def items_text(items: Column) -> Column:
    """Readable one-line form of payload entries, sorted: ``name=value`` or
    ``name.ext=value``; nulls show as ``<null>``."""
    label = lambda x: F.concat(
        x["name"], F.when(x["ext_field"].isNotNull(), F.concat(F.lit("."), x["ext_field"])).otherwise(""),
        F.lit("="), F.coalesce(x["value"], F.lit("<null>")))
    return F.array_join(F.sort_array(F.transform(items, label)), "|")


def items_json(items: Column) -> Column:
    """Payload entries as JSON; a reference nests its key: ``{"Parent": {"External_Id__c": ..}}``."""
    quote = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.array(c)), r"(?s)\A\[(.*)\]\z", 1), F.lit("null"))
    entry = lambda x: F.concat(
        quote(x["name"]), F.lit(":"),
        F.when(x["ext_field"].isNotNull(), F.concat(F.lit("{"), quote(x["ext_field"]), F.lit(":"), quote(x["value"]), F.lit("}")))
         .otherwise(quote(x["value"])))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.sort_array(items), entry), ","), F.lit("}"))
