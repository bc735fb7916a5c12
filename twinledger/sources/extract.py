"""Reading wide tables into the long record/field form, in full or page by page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import repaired, strip_plain
from ..functions.values import stored
from ..model import LONG_COLUMNS, rows
from ..operators.ranking import number_rows

ERROR_COLUMNS = ["env", "obj", "field", "error", "error_code"]


def field_column(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """A direct field or a dotted path through structs; null-safe, None when absent."""
    kind: T.DataType = schema
    column = None
    for name in path.split("."):
        if not isinstance(kind, T.StructType):
            return None
        match = next((f for f in kind.fields if f.name.lower() == name.lower()), None)
        if match is None:
            return None
        column = F.col(f"`{match.name}`") if column is None else column.getField(match.name)
        kind = match.dataType
    return column, kind


def tolerant_select(df: DataFrame, env: str, obj: str, fields: list[str]) -> tuple[list[str], list[tuple]]:
    """Split requested fields into readable ones and error rows, from the schema alone."""
    good, errors = [], []
    for field in dict.fromkeys(fields):
        if field_column(df.schema, field):
            good.append(field)
        elif "." in field:
            relation = field.split(".", 1)[0]
            errors.append((env, obj, field, f"Didn't understand relationship '{relation}'.", "INVALID_FIELD"))
        else:
            errors.append((env, obj, field, f"No such column '{field}' on entity '{obj}'.", "INVALID_FIELD"))
    return good, errors


def unpivot_records(df: DataFrame, obj: str, id_col: str, fields: list[str], env: str,
                    ext_id_col: str | None = None) -> DataFrame:
    """One row per (record, field): a narrow step, no shuffle.  Every value becomes text."""
    ext = stored(F.col(ext_id_col), df.schema[ext_id_col].dataType) if ext_id_col else F.lit(None).cast("string")
    pairs = []
    for f in fields:
        column, kind = field_column(df.schema, f) or (F.lit(None), T.NullType())
        is_text = isinstance(kind, T.StringType)
        pairs.append(F.struct(F.lit(f).alias("field"), F.lit(is_text).alias("_text"),
                              (column if is_text else stored(column, kind)).cast("string").alias("value")))
    # Text is repaired after the rows are split, so the plan holds that expression once
    # however many columns the table has.
    return (df.select(F.lit(env).alias("env"), F.lit(obj).alias("obj"),
                      F.col(id_col).cast("string").alias("record_id"),
                      ext.alias("external_id"), F.inline(F.array(*pairs)))
              .withColumn("value", F.when(F.col("_text"), repaired(F.col("value"))).otherwise(F.col("value")))
              .select(*LONG_COLUMNS))


def join_bucket(key: Column, buckets: int = 32) -> Column:
    """Storage bucket of a join id; both sides must use the same count."""
    text = strip_plain(key)
    number = F.pmod(F.crc32(text.cast("binary")), F.lit(buckets)).cast("string")
    # Padding would cut a fourth digit off.
    padded = F.lpad(number, 3, "0") if buckets <= 1000 else F.when(F.length(number) > 3, number).otherwise(F.lpad(number, 3, "0"))
    return F.when(F.length(text) > 0, padded).otherwise("missing")


def with_bucket(long_df: DataFrame, side: str, buckets: int = 32) -> DataFrame:
    """The join id is the external id on the new side and the record id on the old side."""
    key = F.col("external_id" if side == "new" else "record_id")
    return long_df.withColumn("join_bucket", join_bucket(F.coalesce(key, F.lit("")), buckets))


def row_cap(df: DataFrame, id_col: str, limit: int, group: list[str] | None = None) -> DataFrame:
    """The first ``limit`` rows by id, per group if given."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    ranked = number_rows(df, group or [], [id_col], name="_rank", upto=limit)
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def next_page(df: DataFrame, id_col: str, size: int, after=None) -> DataFrame:
    """One keyset page: the next ``size`` rows with an id above ``after``."""
    rest = df if after is None else df.filter(F.col(id_col) > F.lit(after))
    return row_cap(rest, id_col, size)


@dataclass(frozen=True)
class Extract:
    long: DataFrame
    errors: DataFrame


def extract(spark: SparkSession, env: str, side: str, tables: dict[str, DataFrame],
            fields: dict[str, list[str]], id_col: str | dict = "Id", ext_id_col: str | dict | None = None,
            limit: int | None = None, buckets: int = 32) -> Extract:
    """Flatten every in-scope object of one system.

    Objects without a table or without a readable field give an error row with a blank
    field; unknown fields give one error row each and are left out.
    """
    pick = lambda option, obj: option.get(obj) if isinstance(option, dict) else option
    parts, errors = [], []
    for obj, wanted in sorted(fields.items()):
        df = tables.get(obj)
        if df is None:
            errors.append((env, obj, "", f"sObject type '{obj}' is not supported.", "INVALID_TYPE"))
            continue
        good, bad = tolerant_select(df, env, obj, wanted)
        errors += bad
        if not good:
            errors.append((env, obj, "", "No readable field.", "INVALID_FIELD"))
            continue
        key, ext = pick(id_col, obj), pick(ext_id_col, obj)
        if ext and ext not in df.columns:
            ext = None
        capped = row_cap(df, key, limit) if limit is not None else df
        parts.append(unpivot_records(capped, obj, key, good, env, ext))
    report = rows(spark, ERROR_COLUMNS, list(dict.fromkeys(errors)),
                  "env string, obj string, field string, error string, error_code string")
    if not parts:
        empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in LONG_COLUMNS))
        return Extract(with_bucket(empty, side, buckets), report)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return Extract(with_bucket(out, side, buckets), report)


def wide_records(df: DataFrame, limit: int | None = None, id_col: str = "Id") -> DataFrame:
    """A wide table with an id; rows without one are numbered ``ROW_0``, ``ROW_1`` … in the
    order of all their columns, so that the numbering does not depend on file layout."""
    if id_col in df.columns:
        return df if limit is None else row_cap(df, id_col, limit)
    ranked = number_rows(df, [], list(df.columns), name="_rank", upto=limit)
    if limit is not None:
        ranked = ranked.filter(F.col("_rank") <= limit)
    return ranked.select("*", F.concat(F.lit("ROW_"), (F.col("_rank") - 1).cast("string")).alias(id_col)).drop("_rank")


def catalog_from_tables(spark: SparkSession, tables: dict[str, DataFrame],
                        references: dict[tuple[str, str], tuple[str, list[str]]] | None = None,
                        flags: dict[tuple[str, str], dict[str, bool]] | None = None) -> DataFrame:
    """A field catalogue built from table schemas plus declared references
    ``(object, field) -> (relationship name, objects)`` and flag overrides."""
    from ..model import CATALOG_COLUMNS, CATALOG_DEFAULTS
    kinds = {"string": "string", "boolean": "boolean", "double": "double", "float": "double",
             "bigint": "int", "int": "int", "smallint": "int", "date": "date",
             "timestamp": "datetime", "timestamp_ntz": "datetime"}
    data = []
    for obj, df in sorted(tables.items()):
        for f in df.schema.fields:
            relation, targets = (references or {}).get((obj, f.name), (None, []))
            kind = "reference" if targets else kinds.get(f.dataType.simpleString(), "double")
            marks = {**CATALOG_DEFAULTS, "nillable": f.nullable, **(flags or {}).get((obj, f.name), {})}
            data.append((obj, f.name, kind, f.name, relation, list(targets),
                         *[marks[k] for k in CATALOG_DEFAULTS]))
    return rows(spark, list(CATALOG_COLUMNS), data, ", ".join(f"{k} {v}" for k, v in CATALOG_COLUMNS.items()))
