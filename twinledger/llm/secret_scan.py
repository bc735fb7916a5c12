"""Finding secrets through a trigram index, with DataFrame functions only.

Each rule's regular expression gives a Boolean query over trigrams that any match must contain.
The trigrams of all queries are indexed (trigram to document); the postings of a document are
intersected into the set it holds, the queries are decided on that set, and only documents that
pass are searched with the expression itself.  A rule without mandatory trigrams searches all.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from .common import keyed, same_row

# Alternatives a query may have, and characters a class may stand for, before they are left open.
MOST_STRINGS, MOST_CLASS = 64, 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the expression, and how long its ``group`` has to be."""
    kind: str
    pattern: str
    least: int
    group: int = 0


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)


def _strings(nodes) -> list[set[str] | None]:
    """The expression as a sequence of finite sets of strings; None where it is open."""
    out: list[set[str] | None] = []
    for kind, value in nodes:
        if kind is op.LITERAL:
            out.append({chr(value).lower()})
        elif kind is op.SUBPATTERN:
            out.extend(_strings(value[-1]))
        elif kind is op.BRANCH:
            options: set[str] | None = set()
            for branch in value[1]:
                parts = _joined(_strings(branch))
                options = None if options is None or len(parts) != 1 or parts[0] is None else options | parts[0]
            out.append(options)
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= MOST_CLASS:
            out.append({chr(v).lower() for _, v in value})
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
            parts = _joined(_strings(value[2]))
            out.append({"", *parts[0]} if len(parts) == 1 and parts[0] is not None else None)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            out.extend([*_strings(value[2]), None])
        else:
            out.append(None)
    return out


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring finite sets put together, as long as they stay few."""
    out: list[set[str] | None] = [{""}]
    for part in parts:
        last = out[-1]
        if part is None:
            out.append(None)
        elif last is not None and len(last) * len(part) <= MOST_STRINGS:
            out[-1] = {a + b for a in last for b in part}
        else:
            out.append(part)
    return [p for p in out if p != {""}] or [{""}]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, of which a matching text (in lower case) holds all trigrams of at least one.
    No alternatives: the expression has no mandatory trigrams."""
    best: list[frozenset[str]] = []
    for part in _joined(_strings(parser.parse(pattern))):
        if part is None:
            continue
        needs = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in part}
        if all(needs):
            needs = {n for n in needs if not any(other < n for other in needs)}
            if not best or min(map(len, needs)) > min(map(len, best)):
                best = sorted(needs, key=sorted)
    return best


def trigram_index(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, _id, _h``: which row holds which of the trigrams."""
    lowered = rows.select("_id", "_h", F.lower("_text").alias("_lower"))
    held = F.array_compact(F.array(*[F.when(F.col("_lower").contains(t), F.lit(t)) for t in trigrams]))
    return lowered.select(F.explode(held).alias("trigram"), "_id", "_h")


def running_sums(values: Column, block: int = 512) -> Column:
    """Sums up to and including each entry, block-wise: appending copies a block, not the array."""
    many = F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / block), F.lit(0)).cast("int"))
    blocks = F.transform(many, lambda b: F.slice(values, b * block + 1, F.lit(block)))

    def sums(v: Column) -> Column:
        return F.aggregate(v, F.array().cast("array<long>"), lambda done, x: F.concat(
            done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("long")) + x)))
    inner = F.transform(blocks, sums)
    ahead = sums(F.transform(inner, lambda v: F.coalesce(F.try_element_at(v, F.lit(-1)), F.lit(0).cast("long"))))
    before = F.concat(F.array(F.lit(0).cast("long")), ahead)
    return F.flatten(F.transform(inner, lambda v, i: F.transform(v, lambda x: x + F.element_at(before, i + 1))))


SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _kept_spans(matches: Column, rule: Rule, rank: int) -> Column:
    """Matches (end ``e``, length ``w``, length ``p`` of the part that counts) that are long enough, as spans."""
    kept = F.filter(matches, lambda m: m["p"] >= rule.least)
    placed = F.transform(kept, lambda m: F.struct((m["e"] - m["w"]).alias("start"), F.lit(rank).alias("rank"),
                                                  F.lit(rule.kind).alias("kind"), m["e"].alias("end")))
    return F.coalesce(placed, F.array()).cast(SPANS)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Spans of every rule in every text: ``key`` and ``spans``, an array of (start, rank, kind, end) by
    start, then by the rules' order; code points, the end exclusive.

    Matches are the leftmost non-overlapping ones of each rule; those whose ``group`` is too short
    are dropped afterwards.  Null counts as empty.  One row per input row, repeated rows and
    rows without an id included; other columns are ignored.
    """
    rows = keyed(docs, text, key)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    trigrams = sorted({t for q in queries.values() for need in q for t in need})
    found = rows.withColumn("_held", F.array().cast("array<string>"))
    if trigrams:
        held = trigram_index(rows, trigrams).groupBy("_id", "_h").agg(F.collect_set("trigram").alias("_held"))
        found = rows.join(held, same_row(rows, held), "left").select(rows["*"], held["_held"])
    spans = []
    for rank, rule in enumerate(rules):
        passes = F.col("_text").rlike(rule.pattern)
        if queries[rule.kind]:
            some = F.lit(False)
            for need in queries[rule.kind]:
                every = F.lit(True)
                for t in sorted(need):
                    every = every & F.array_contains("_held", t)
                some = some | every
            passes = F.coalesce(some, F.lit(False)) & passes
        whole, part = f"_whole{rank}", f"_part{rank}"
        lengths = lambda c: F.transform(c, lambda s: F.length(s).cast("long"))
        pattern = F.lit(rule.pattern)
        found = (found.withColumn(f"_hit{rank}", passes)
                 .withColumn(f"_gap{rank}", F.when(F.col(f"_hit{rank}"), lengths(F.split("_text", rule.pattern, -1))))
                 .withColumn(whole, F.when(F.col(f"_hit{rank}"), lengths(F.regexp_extract_all("_text", pattern, F.lit(0)))))
                 .withColumn(part, F.when(F.col(f"_hit{rank}"), lengths(F.regexp_extract_all("_text", pattern, F.lit(rule.group))))
                             if rule.group else F.col(whole)))
        # Text between matches and matches take turns; the end of a match is all that came so far.
        steps = F.zip_with(F.slice(F.col(f"_gap{rank}"), 1, F.size(whole)), F.col(whole), lambda a, b: a + b)
        found = found.withColumn(f"_end{rank}", F.when(F.col(f"_hit{rank}"), running_sums(steps)))
        sized = F.zip_with(whole, part, lambda w, p: F.struct(w.alias("w"), p.alias("p")))
        both = F.zip_with(f"_end{rank}", sized, lambda e, m: F.struct(e.alias("e"), m["w"].alias("w"), m["p"].alias("p")))
        spans.append(_kept_spans(both, rule, rank))
    return found.select(F.col("_id").alias(key), F.array_sort(F.concat(*spans)).alias("spans"))


