"""Record and field parity of two long extracts.

Both sides are stacked with a side flag and meet in one shuffle on (object, join key): the
field level and the record level are aggregates over that same partitioning.  Keys that hold
an outsized share of the rows (duplicated external ids) take a second route that aggregates
per (object, key, field) ahead of the shuffle.  Arrays are built only for records that can be
reported, and hold at most one entry per field name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.markup import has_markup, with_clean_text
from ..functions.text import BLANK_IN_KEYS, canonical, cell, strip_name, unless_blank
from ..model import DATA_GAP, LONG_COLUMNS, MISSING_FROM
from .exclude import comparison_spec, exclusion_audit, hard_excluded, spec_table
from .patterns import with_spec
from .skew import hot_keys, is_hot

KEY = ["obj", "key"]
# The order in which aggregates sort: what tells most rows apart comes first, so that its first bytes settle most comparisons.
SORTED = ["key", "obj"]


@dataclass(frozen=True)
class Parity:
    """``paired`` holds one row per reported record with its field entries; ``records`` and
    ``fields`` are narrow views of it, so write ``paired`` once and derive both from there.
    The audits are separate scans of the narrow columns they need."""

    paired: DataFrame
    stacked: DataFrame
    raw: tuple[DataFrame, DataFrame]
    exclusions: DataFrame | None
    comparison_excluded: tuple | DataFrame

    @property
    def records(self) -> DataFrame:
        return records(self.paired)

    @property
    def fields(self) -> DataFrame:
        return fields(self.paired)

    def _both(self) -> DataFrame:
        new, old = (normalised(df).drop("seq") for df in self.raw)
        return new.unionByName(old)

    @property
    def excluded(self) -> DataFrame:
        """Rows left out, counted by reason."""
        return exclusion_audit(self._both(), self.exclusions, self.comparison_excluded)

    @property
    def cleaned(self) -> DataFrame:
        """Values that markup removal changes."""
        return cleaned_values(hard_excluded(self._both(), self.exclusions))

    @property
    def unkeyed(self) -> DataFrame:
        """Rows and records without a join key, which take no part in the comparison."""
        return self.stacked.filter(F.col("key").isNull()).groupBy(
            "obj", F.when(F.col("is_new"), "new").otherwise("old").alias("side")).agg(
            F.count("*").alias("row_count"), F.count_distinct("record_id").alias("record_count"))


def normalised(long_df: DataFrame) -> DataFrame:
    """Identifier columns under the blank rules of keys; the value is left alone."""
    rest = ["seq"] if "seq" in long_df.columns else []
    trimmed = long_df.select(*[F.col(c) if c == "value" else strip_name(c).alias(c) for c in LONG_COLUMNS], *rest)
    return trimmed.select(*[F.col(c) if c == "value" else unless_blank(F.col(c), BLANK_IN_KEYS).alias(c) for c in LONG_COLUMNS], *rest)


def cleaned_values(long_df: DataFrame) -> DataFrame:
    """One audit row per value that markup removal changed, with 1000-character samples."""
    hit = long_df.filter(has_markup(F.col("value")))
    hit = with_clean_text(hit, "value", "_clean")
    return hit.filter(F.col("_clean") != F.col("value")).select(
        "env", "obj", "record_id", "field",
        F.lit("Removed HTML/CSS/Office markup from value").alias("reason"),
        cell(F.substring("value", 1, 1000)).alias("original_value_sample"),
        cell(F.substring("_clean", 1, 1000)).alias("cleaned_value_sample"))


def _side(long_df: DataFrame, side: str, key: str, exclusions, clean: bool) -> DataFrame:
    df = hard_excluded(normalised(long_df), exclusions)
    if clean:
        df = with_clean_text(df, "value")
    seq = F.col("seq").cast("long") if "seq" in df.columns else F.lit(0).cast("long")
    return df.select("obj", F.col(key).alias("key"), F.lit(side == "new").alias("is_new"), seq.alias("seq"),
                     "record_id", "external_id", "field", "value")


def differs(new_value: Column, old_value: Column) -> Column:
    """Not equal after canonicalisation.  Null equals null only; the empty string is a value.
    Equal raw text, the common case, is settled without touching the text rules."""
    return ~new_value.eqNullSafe(old_value) & ~canonical(new_value).eqNullSafe(canonical(old_value))


def _field_level(rows: DataFrame) -> DataFrame:
    """One row per (object, key, field): each side's last value and first identity."""
    new, value = F.col("is_new"), F.struct("seq", "record_id", "value")
    identity = F.struct("seq", "record_id", "external_id")
    return rows.groupBy(*SORTED, "field").agg(
        F.max(F.when(new, value)).alias("n"), F.max(F.when(~new, value)).alias("o"),
        F.min(F.when(new, identity)).alias("new_first"), F.min(F.when(~new, identity)).alias("old_first"))


def _record_level(field_rows: DataFrame, specs, table: DataFrame | None) -> DataFrame:
    spec = comparison_spec(specs) if table is None else F.col("spec")
    field_rows = field_rows if table is None else with_spec(field_rows, table)
    field_rows = field_rows.select("*", differs(F.col("n.value"), F.col("o.value")).alias("differs"),
                                   spec.isNotNull().alias("load_only"))
    both = F.col("n").isNotNull() & F.col("o").isNotNull()
    entry = F.struct("field", F.col("n.value").alias("new_value"), F.col("o.value").alias("old_value"),
                     F.col("n").isNotNull().alias("in_new"), F.col("o").isNotNull().alias("in_old"),
                     "differs", "load_only")
    # An equal field seen on both sides proves a matched record and is never reported.
    keep = F.col("field").isNotNull() & (F.col("differs") | F.col("load_only") | ~both)
    out = field_rows.groupBy(*SORTED).agg(
        F.min("new_first").alias("new_first"), F.min("old_first").alias("old_first"),
        F.max(F.col("differs") & ~F.col("load_only") & F.col("field").isNotNull()).alias("gap"),
        F.collect_list(F.when(keep, entry)).alias("items"))
    matched = F.col("new_first").isNotNull() & F.col("old_first").isNotNull()
    kind = (F.when(F.col("old_first").isNull(), MISSING_FROM + "old")
             .when(F.col("new_first").isNull(), MISSING_FROM + "new")
             .when(F.col("gap"), DATA_GAP))
    items = F.when(matched, F.filter("items", lambda x: x["differs"] | x["load_only"])).otherwise(F.col("items"))
    return (out.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
               .select("obj", "key", F.col("new_first.record_id").alias("new_record_id"),
                       F.col("old_first.record_id").alias("old_record_id"),
                       F.col("new_first.external_id").alias("external_id"), "change_type",
                       F.sort_array(items).alias("items")))


def record_parity(new_long: DataFrame, old_long: DataFrame, exclusions: DataFrame | None = None,
                  comparison_excluded=(), clean_markup: bool = False, hot: list[int] | None = None) -> Parity:
    """Full outer comparison: new rows join by external id, old rows by record id.

    A record exists when it has any row left after hard exclusion, even if all its fields
    are excluded from comparison.  Rows without a join key are counted in ``unkeyed``.
    """
    sides = [(new_long, "new", "external_id"), (old_long, "old", "record_id")]
    stacked = None
    for df, side, key in sides:
        part = _side(df, side, key, exclusions, clean_markup)
        stacked = part if stacked is None else stacked.unionByName(part)
    keyed = stacked.filter(F.col("key").isNotNull() & F.col("obj").isNotNull())
    raw = reduce(DataFrame.unionByName, [df.select(*[F.col(c).cast("string").alias(k) for c, k in zip(("obj", key), KEY)]) for df, _, key in sides])
    hot = hot_keys(keyed.select(*KEY), KEY, raw) if hot is None else hot
    key_columns = [F.col(k) for k in KEY]
    cold = keyed.filter(~is_hot(key_columns, hot)) if hot else keyed
    table = spec_table(keyed.select("obj", "field"), comparison_excluded)
    paired = _record_level(_field_level(cold.repartition(*KEY)), comparison_excluded, table)
    if hot:
        # No repartition here: the field-level aggregate combines ahead of its own shuffle.
        paired = paired.unionByName(_record_level(
            _field_level(keyed.filter(is_hot(key_columns, hot))), comparison_excluded, table))
    return Parity(paired, stacked, (new_long, old_long), exclusions,
                  comparison_excluded if isinstance(comparison_excluded, DataFrame) else tuple(comparison_excluded))


def _map(items: Column, name: str) -> Column:
    return F.map_from_entries(F.transform(items, lambda x: F.struct(x["field"], x[name])))


def records(paired: DataFrame) -> DataFrame:
    """Reported records with their payload maps (compared fields and load-only fields)."""
    gap = F.col("change_type") == DATA_GAP

    def part(load_only: bool, side: str) -> Column:
        flag = lambda x: x["load_only"] if load_only else ~x["load_only"]
        shown = (lambda x: flag(x) & x[f"in_{side}"]) if load_only else (lambda x: flag(x) & (gap | x[f"in_{side}"]))
        return _map(F.filter("items", shown), f"{side}_value")

    compared = F.filter("items", lambda x: ~x["load_only"])
    change = F.map_from_entries(F.transform(compared, lambda x: F.struct(
        x["field"], F.struct(x["old_value"].alias("from"), x["new_value"].alias("to")))))
    return paired.select(
        "obj", "new_record_id", "old_record_id", "external_id",
        part(False, "new").alias("new_value"), part(False, "old").alias("old_value"),
        change.alias("field_diff"), "change_type",
        part(True, "new").alias("new_load_value"), part(True, "old").alias("old_load_value"))


def _shown(x: Column) -> Column:
    """Whether an entry is reported as a field: compared, and of a missing record not null."""
    return ~x["load_only"] & ((F.col("change_type") == DATA_GAP) | x["new_value"].isNotNull() | x["old_value"].isNotNull())


def shown_fields() -> Column:
    """How many rows :func:`fields` makes of a paired row."""
    return F.size(F.filter("items", _shown))


def fields(paired: DataFrame) -> DataFrame:
    """One row per reported field.  Missing records skip fields that are null; ids and
    values are CSV cells (null is empty, line breaks escaped)."""
    rows = paired.select("*", F.explode("items").alias("x")).filter(_shown(F.col("x")))
    return rows.select(
        "obj", F.col("x.field").alias("field"), cell(F.col("new_record_id")).alias("new_record_id"),
        cell(F.col("old_record_id")).alias("old_record_id"), cell(F.col("external_id")).alias("external_id"),
        cell(F.col("x.new_value")).alias("new_value"), cell(F.col("x.old_value")).alias("old_value"), "change_type")
