"""Many ``Object.Field`` patterns at once, by an index of their literal ends.

A pattern can only match a name that begins with the literal text ahead of its first wildcard and ends with that behind its last.
The longer of the two is its key; a name looks up its own beginnings and ends, of the lengths that
occur as keys, and tests the few patterns it finds.  Names are tested once each, however many rows hold them.
"""

from __future__ import annotations

import fnmatch
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import rows
from ..session import checkpointed, small

# Up to so many patterns are cheaper as an expression over the rows.
FEW = 64
INDEX = "place long, spec string, key string, size int, obj_test string, field_test string"
_WILD = re.compile(r"[*?\[]")
_LAST = re.compile(r"[*?\]]")


def _test(pattern: str) -> str | None:
    """A regular expression for what a key leaves open; None if nothing is left."""
    if pattern == "*":
        return None
    return rf"\A{re.sub(r'\\[Zz]$', '', fnmatch.translate(pattern))}\z"


def _entry(place: int, spec: str) -> tuple:
    o, f = spec.split(".", 1) if "." in spec else ("*", spec)
    wild = _WILD.search(f)
    if not wild:
        return place, spec, f"f{f}", len(f), _test(o), None
    head = f[:wild.start()]
    tail = f[max(m.end() for m in _LAST.finditer(f)):] if _LAST.search(f) else ""
    left = None if f in (f"{head}*", f"*{tail}") else _test(f)
    if head or tail:
        return (place, spec, f"p{head}", len(head), _test(o), left) if len(head) >= len(tail) else (place, spec, f"s{tail}", len(tail), _test(o), left)
    if not _WILD.search(o):
        return place, spec, f"o{o}", len(o), None, left
    return place, spec, "x", 0, _test(o), left


def pattern_index(specs: DataFrame) -> DataFrame:
    """The index of ``place, spec`` rows: patterns that are blank go, the first of equal ones stays."""
    clean = specs.select("place", F.trim("spec").alias("spec")).filter(F.length("spec") > 0).groupBy("spec").agg(F.min("place").alias("place"))

    def entries(frames):
        for frame in frames:
            yield pd.DataFrame([_entry(p, s) for p, s in zip(frame["place"], frame["spec"])], columns=[c.split()[0] for c in INDEX.split(", ")])
    return clean.select("place", "spec").mapInPandas(entries, INDEX)


def listed(spark: SparkSession, specs) -> DataFrame:
    """Patterns in their order as ``place, spec``."""
    return rows(spark, ["place", "spec"], list(enumerate(specs)), "place long, spec string")


def first_specs(names: DataFrame, specs: DataFrame) -> DataFrame:
    """``obj, field, spec`` for the ``obj, field`` rows that a pattern matches, with the first in the order of ``place``.
    Null counts as empty text.  A pattern without any literal end, in the field or as its object, is tested on every name."""
    index = checkpointed(pattern_index(specs))
    # Lengths of keys: as many as the longest pattern has letters.
    lengths = {k: sorted(r.size for r in index.filter(F.col("key").startswith(k)).select("size").distinct().collect()) for k in "ps"}
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    asked = names.select("obj", "field", text("obj").alias("_o"), text("field").alias("_f")).distinct()
    size = F.length("_f")
    keys = [F.concat(F.lit("f"), "_f"), F.concat(F.lit("o"), "_o"), F.lit("x"),
            *[F.when(size >= n, F.concat(F.lit("p"), F.substring("_f", 1, n))) for n in lengths["p"]],
            *[F.when(size >= n, F.concat(F.lit("s"), F.right(F.col("_f"), F.lit(n)))) for n in lengths["s"]]]
    asked = asked.withColumn("key", F.explode(F.array_compact(F.array(*keys))))
    found = asked.join(small(index), "key")
    for column, test in (("_o", "obj_test"), ("_f", "field_test")):
        found = found.filter(F.col(test).isNull() | F.expr(f"rlike({column}, {test})"))
    return found.groupBy("obj", "field").agg(F.min_by("spec", "place").alias("spec"))


def with_spec(df: DataFrame, table: DataFrame, name: str = "spec") -> DataFrame:
    """Add what :func:`first_specs` says of each row's names."""
    found = table.select(F.col("obj").alias("_po"), F.col("field").alias("_pf"), F.col("spec").alias(name))
    return df.join(small(found), df["obj"].eqNullSafe(F.col("_po")) & df["field"].eqNullSafe(F.col("_pf")), "left").drop("_po", "_pf")
