"""Column names and schemas shared by all operators.

Fixed values: field names, change types and outcome words below are part of the data
contract with existing extracts, diffs and load results, so they are spelled out here once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EXTERNAL_ID = "External_Id__c"
RECORD_TYPE = "RecordType"
RECORD_TYPE_ID = "RecordTypeId"
MIGRATION_KEY = "Old_Org_Id__c"

DATA_GAP = "data_gap"
MISSING_FROM = "missing_from_"

LONG_COLUMNS = ["env", "obj", "record_id", "field", "value", "external_id"]

RECORD_KEY = ["target_object", "source_record_id"]

WORK_COLUMNS = ["target_object", "source_object", "source_record_id", "target_record_id", "change_type"]

RESULT_COLUMNS = [
    "target_env", "source_env", "target_object", "source_object", "source_record_id",
    "target_record_id", "change_type", "operation", "dry_run", "success",
    "payload_field_count", "payload_json", "skipped_fields", "message",
]

CATALOG_COLUMNS = {
    "object": "string", "field": "string", "type": "string", "label": "string",
    "relationship_name": "string", "reference_to": "array<string>",
    "queryable": "boolean", "createable": "boolean", "updateable": "boolean",
    "nillable": "boolean", "external_id": "boolean", "filterable": "boolean",
    "calculated": "boolean", "auto_number": "boolean",
}

CATALOG_DEFAULTS = {
    "queryable": True, "createable": True, "updateable": True, "nillable": True,
    "external_id": False, "filterable": True, "calculated": False, "auto_number": False,
}

# One payload entry.  ``ext_field`` is set when the entry is a reference by another
# record's key (``name`` is then the relationship name), and null for a plain field.
ITEM = "struct<name:string,ext_field:string,value:string>"


def rows(spark: SparkSession, columns: list[str], data: list[tuple], schema: str | None = None) -> DataFrame:
    """A small configuration table.  Built through Arrow so that it is a local relation
    whose exact size the optimizer knows."""
    arrays = [pa.array([r[i] for r in data], type=None if data and any(r[i] is not None for r in data) else pa.string())
              for i in range(len(columns))]
    df = spark.createDataFrame(pa.table(dict(zip(columns, arrays))))
    return df.to(T._parse_datatype_string(schema)) if schema else df


def catalog(df: DataFrame) -> DataFrame:
    """Complete a field catalogue: missing flags take their defaults, extra columns go."""
    have = set(df.columns)

    def column(name: str, kind: str) -> Column:
        default = F.lit(CATALOG_DEFAULTS.get(name)).cast(kind)
        return (F.coalesce(F.col(name).cast(kind), default) if name in have else default).alias(name)

    return df.select([column(n, k) for n, k in CATALOG_COLUMNS.items()])


def env_names(df: DataFrame, new_env: str, old_env: str) -> DataFrame:
    """Rename neutral parity columns to the per-environment names of the stored format:
    ``{env}_recordid`` in lower case and ``{env}_value`` / ``{env}_load_value`` as given."""
    out = df
    for side, env in (("new", new_env), ("old", old_env)):
        out = (out.withColumnRenamed(f"{side}_record_id", f"{env.lower()}_recordid")
                  .withColumnRenamed(f"{side}_value", f"{env}_value")
                  .withColumnRenamed(f"{side}_load_value", f"{env}_load_value"))
    out = out.withColumnsRenamed({"obj": "Obj", "field": "Field", "external_id": EXTERNAL_ID})
    if "change_type" in out.columns:
        kind = F.col("change_type")
        out = out.withColumn(
            "change_type",
            F.when(kind == MISSING_FROM + "new", MISSING_FROM + new_env.lower())
             .when(kind == MISSING_FROM + "old", MISSING_FROM + old_env.lower()).otherwise(kind))
    return out
