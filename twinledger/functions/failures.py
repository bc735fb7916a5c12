"""Error texts of load results: parsing, categories, masking, first-look advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .literals import literal_json
from .text import collapse, joined, load_text, strip

# Identifier shapes that are masked before failures are grouped.
URL_ID = r"/(?:sobjects|r)/([A-Za-z0-9_]+)/(?:[A-Za-z0-9]{15,18})"
RECORD_ID = (r"(?U)\b(?:001|003|005|006|00Q|00v|701|01s|01t|01u|0MI|0MK|00K|"
             r"a[0-9A-Za-z]{2})[A-Za-z0-9]{12}(?:[A-Za-z0-9]{3})?\b")
MEMBER = r"(?iU)member id '[^']*' or the campaign id '[^']*'"
MEMBER_MASK = "member id '<MEMBER_ID>' or the campaign id '<CAMPAIGN_ID>'"

# Fixed values: (category, codes, phrases) for anything but skips; first match wins.
CATEGORIES = [
    ("Duplicate Rule / Duplicate Value", ["DUPLICATES_DETECTED", "DUPLICATE_VALUE"], ["duplicate"]),
    ("Validation Rule", ["FIELD_CUSTOM_VALIDATION_EXCEPTION"], ["validation"]),
    ("Missing Required Field", ["REQUIRED_FIELD_MISSING"], ["required fields are missing"]),
    ("Read-Only Field / Field Access", ["INVALID_FIELD_FOR_INSERT_UPDATE"], ["unable to create/update fields"]),
    ("Field Integrity / Reference", ["FIELD_INTEGRITY_EXCEPTION"], ["field integrity exception"]),
    ("Restricted Picklist", ["INVALID_OR_NULL_FOR_RESTRICTED_PICKLIST"], ["restricted picklist"]),
    ("Field Length", ["STRING_TOO_LONG"], ["data value too large"]),
    ("Inactive Owner/User", ["INACTIVE_OWNER_OR_USER"], ["inactive user", "inactive owner"]),
    ("Automation / Trigger / Flow", ["CANNOT_INSERT_UPDATE_ACTIVATE_ENTITY"], ["trigger", "flow"]),
]


def masked(c: Column) -> Column:
    text = F.regexp_replace(c, URL_ID, r"/$1/<SF_ID>")
    text = F.regexp_replace(text, RECORD_ID, "<SF_ID>")
    text = F.regexp_replace(text, MEMBER, MEMBER_MASK)
    return F.coalesce(collapse(text), F.lit(""))


def short_message(c: Column) -> Column:
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), r"https://\S+", "URL"))


def extract_error(c: Column) -> Column:
    """Short form of a read error: only the missing column or relationship is named."""
    text = collapse(c)
    column = r"No such column '([^']+)' on entity '([^']+)'"
    relation = r"Didn't understand relationship '([^']+)'"
    return (F.when(text.rlike(column), F.concat(F.regexp_extract(text, column, 0), F.lit(".")))
             .when(text.rlike(relation), F.concat(F.regexp_extract(text, relation, 0), F.lit(".")))
             .otherwise(text))


def failed_field(message: Column, requested: Column) -> Column:
    """Which requested field a read error is about, or the name it gives."""
    named = F.nullif(F.regexp_extract(message, r"No such column '([^']+)'", 1), F.lit(""))
    related = F.nullif(F.regexp_extract(message, r"Didn't understand relationship '([^']+)'", 1), F.lit(""))
    by_name = F.filter(requested, lambda f: (f == named) | f.endswith(F.concat(F.lit("."), named)))
    by_relation = F.filter(requested, lambda f: (f == related) | f.startswith(F.concat(related, F.lit("."))))
    return F.when(named.isNotNull(), F.coalesce(F.get(by_name, F.lit(0)), named)).otherwise(
        F.coalesce(F.get(by_relation, F.lit(0)), related))


def field_list(text: Column) -> Column:
    """A field list given as JSON or single-quoted array text, or as plain text."""
    clean = strip(text)
    parsed = F.from_json(F.when(clean.startswith("["), literal_json(clean)), "array<string>")
    return F.coalesce(F.when(parsed.isNotNull(), joined(F.transform(parsed, strip))).otherwise(clean), F.lit(""))


def _variant_list(v: Column, path: str) -> Column:
    return F.coalesce(
        joined(F.transform(F.try_variant_get(v, path, "array<string>"), strip)),
        field_list(F.try_variant_get(v, path, "string")), F.lit(""))


def with_parsed_error(df: DataFrame, message: str = "message") -> DataFrame:
    """Add ``error_code``, ``error_fields`` and ``error_message`` parsed from a raw message.

    JSON is read as such; a literal of the same structure, in whatever quotes, is rewritten to JSON
    first (``literals``); anything else goes through three patterns.
    Steps are separate columns because each is used several times by the next.
    """
    marker = "Response content:"
    raw, content, v = F.col("_raw"), F.col("_content"), F.col("_v")
    first, bulk = F.col("_first"), F.col("_bulk")
    def is_object(node: Column, path: str) -> Column:
        return F.try_variant_get(node, path, "map<string,variant>").isNotNull()

    def text(node: Column, path: str) -> Column:
        return load_text(F.try_variant_get(node, path, "string"))

    df = df.withColumn("_raw", load_text(F.col(message)))
    df = df.withColumn("_content", F.when(raw.contains(marker), strip(F.substring(
        raw, F.instr(raw, marker) + len(marker), F.length(raw)))).otherwise(raw))
    df = df.withColumn("_v", F.try_parse_json(content))
    df = df.withColumn("_v", F.when(v.isNull() & content.rlike(r"\A[\[{(]"), F.try_parse_json(literal_json(content))).otherwise(v))
    df = df.withColumn("_first", F.coalesce(F.try_variant_get(v, "$[0]", "variant"), F.when(is_object(v, "$"), v)))
    df = df.withColumn("_bulk", F.try_variant_get(first, "$.errors[0]", "variant"))
    df = df.withColumn("_bulk_text", text(first, "$.errors"))
    # How the message is built, then what it says.
    df = df.withColumn("_form", F.when(raw.isNull(), "none").when(first.isNull(), "text")
                       .when(is_object(bulk, "$"), "bulk").when(bulk.isNotNull(), "bulk_text")
                       .when(F.col("_bulk_text").isNotNull() & ~F.col("_bulk_text").startswith("["), "errors_text")
                       .when(is_object(first, "$.duplicateResult"), "duplicate").otherwise("plain"))
    form, blank = F.col("_form"), F.lit("")
    pattern = lambda p: F.regexp_extract(raw, p, 1)
    code = (F.when(form == "text", pattern(r"""['"]errorCode['"]:\s*['"]([^'"]+)['"]"""))
             .when(form == "bulk", F.coalesce(text(bulk, "$.statusCode"), text(bulk, "$.errorCode")))
             .when(form == "duplicate", F.coalesce(text(first, "$.errorCode"), F.lit("DUPLICATES_DETECTED")))
             .when(form == "plain", text(first, "$.errorCode")))
    fields = (F.when(form == "text", field_list(pattern(r"""['"]fields['"]:\s*(\[[^\]]*\])""")))
               .when(form == "bulk", _variant_list(bulk, "$.fields"))
               .when(form.isin("duplicate", "plain"), _variant_list(first, "$.fields")))
    said = (F.when(form == "text", F.coalesce(F.nullif(pattern(r"""['"]message['"]:\s*['"]([^'"]+)['"]"""), blank), short_message(raw)))
             .when(form == "bulk", text(bulk, "$.message")).when(form == "bulk_text", text(bulk, "$"))
             .when(form == "errors_text", F.col("_bulk_text"))
             .when(form == "duplicate", F.coalesce(text(first, "$.duplicateResult.errorMessage"), text(first, "$.message")))
             .when(form == "plain", text(first, "$.message")))
    df = df.withColumn("error_code", F.coalesce(code, blank)).withColumn("error_fields", F.coalesce(fields, blank)).withColumn(
        "error_message", F.coalesce(said, short_message(raw), blank))
    return df.drop("_raw", "_content", "_v", "_first", "_bulk", "_bulk_text", "_form")


def category(operation: Column, code: Column, message: Column) -> Column:
    upper, low = F.upper(F.coalesce(code, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    skip = (F.when(low.contains("related record not found") | (low.contains("target") & low.contains("not found")),
                   "Missing Related Record")
             .when(low.contains("no writable mapped fields"), "No Writable Mapped Fields")
             .otherwise("Loader Skip"))
    out = F.when(operation == "skip", skip)
    for name, codes, phrases in CATEGORIES:
        hit = upper.isin(*codes)
        for phrase in phrases:
            hit = hit | low.contains(phrase)
        out = out.when(hit, name)
    return out.when(upper != "", upper).otherwise("Unclassified")


def advice(target: Column, code: Column, kind: Column, fields: Column, text: Column, payload_fields: Column) -> Column:
    """Where to look first for a group of failures; ordered rules, first match wins.  The
    conditions follow the established rule order; the wording is this library's own."""
    t, kind, names = F.lower(text), F.lower(kind), F.lower(payload_fields)
    code = F.coalesce(code, F.lit(""))

    def any_of(*phrases):
        hit = F.lit(False)
        for p in phrases:
            hit = hit | t.contains(p)
        return hit

    return (
        F.when(any_of("cannot change pricebook on opportunity with line items"),
               "Price book is fixed once line items exist: leave it out of the update or set it before the items.")
        .when((code == "UNABLE_TO_LOCK_ROW") | any_of("unable to obtain exclusive access"),
              "Row lock: usually passes on a rerun; if it stays, load the shared parents separately.")
        .when(any_of("remote end closed connection", "connection aborted", "bulk api batch failed"),
              "Transport or batch failure before row results came back: retry these rows.")
        .when((target == "CampaignMember") & t.contains("member id") & t.contains("campaign id"),
              "Member row lacks its contact or lead: the parent is missing, ignored or failed earlier.")
        .when(any_of("inactive owner", "inactive_owner_or_user"),
              "Owner is inactive: run owner replacement and check which fields bypass it.")
        .when(any_of("duplicate") | code.isin("DUPLICATES_DETECTED", "DUPLICATE_VALUE", "DUPLICATE_COMM_NICKNAME"),
              "Duplicate or unique rule blocks the write: check that the matched record is the right one.")
        .when((code == "REQUIRED_FIELD_MISSING") | kind.contains("required field") | any_of("required fields are missing"),
              "Required field is empty: a reference did not resolve or the field is not mapped.")
        .when((code == "FIELD_CUSTOM_VALIDATION_EXCEPTION") | kind.contains("validation"),
              "Validation rule blocks the write: confirm the bypass or clean the source data.")
        .when((code == "INVALID_FIELD_FOR_INSERT_UPDATE") | any_of("not writable", "unable to create/update fields"),
              "Field cannot be written in this operation: drop or reroute its mapping.")
        .when(((code == "FIELD_INTEGRITY_EXCEPTION") | kind.contains("field integrity")) & (fields != ""),
              F.concat(F.lit("Integrity failure on "), fields, F.lit(": bad reference, picklist value or record state.")))
        .when((code == "FIELD_INTEGRITY_EXCEPTION") | kind.contains("field integrity"),
              "Integrity failure: bad reference, picklist value or record state.")
        .when(any_of("lookup filter"),
              "Reference resolved but the lookup filter rejects it: have the data owner confirm the record.")
        .when(any_of("insufficient access", "insufficient_access"),
              "Access problem: check sharing and permissions of the loading user.")
        .when(names.contains("external_id__c") & t.contains("invalid"),
              "External key looks invalid: check that legacy ids are kept and references resolve.")
        .otherwise("Grouped by masked message: look at the sample payload and message to classify it."))
