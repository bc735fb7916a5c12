"""The registered queries of the operators and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read
from .decontaminate import contaminated
from .exact_dedup import exact_groups
from .exact_search import top_scores
from .fill_middle import fill_in_middle
from .html_extract import extract_text
from .language import identify
from .line_dedup import drop_repeated_lines
from .mixing import mix_sources
from .near_dedup import near_groups
from .secret_scan import scan_secrets
from .substring_dedup import drop_repeated_passages
from .suffix_dedup import drop_repeated_bytes
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return register


@query()
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = drop_repeated_passages(read(spark, sf, "documents"), length=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = drop_repeated_bytes(read(spark, sf, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_SPANS = r"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
       sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s,
       sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e, length(g) AS n
FROM (SELECT doc_id, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, regexp_extract_all(text, '{pattern}', {group}) AS gs,
                   regexp_split_to_array(text, '{pattern}') AS gaps FROM documents) WHERE len(ms) > 0)"""
_ANY = lambda w: "".join(f"[{c.upper()}{c}]" for c in w)
_ASSIGN = ("(" + "|".join(map(_ANY, ("password", "passwd", "secret", "token"))) + "|" + _ANY("api") + "_?" + _ANY("key")
           + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


@query(rf"""
WITH found AS (
  SELECT * FROM ({_SPANS.format(rank=0, kind="assign", pattern=_ASSIGN, group=2)}) WHERE n >= 12
  UNION ALL SELECT * FROM ({_SPANS.format(rank=1, kind="access", pattern="AKIA[A-Z0-9]+", group=0)}) WHERE n >= 18
  UNION ALL SELECT * FROM ({_SPANS.format(rank=2, kind="hex", pattern="[0-9a-f]+", group=0)}) WHERE n >= 16),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
               string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, rank) AS spans FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id""")
def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = scan_secrets(read(spark, sf, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(told, 256).alias("base_sha256"), told.alias("spans"))


@query(r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t""")
def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(read(spark, sf, "documents"))


@query(r"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
keyed AS (SELECT *, md5('mix|' || doc_id || '|' || size) AS k FROM sized),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, (r % 3 + 1)::DOUBLE AS weight FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
       FROM s2 WINDOW w AS (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM s4),
q AS (SELECT source, k, sum(size) AS words FROM keyed GROUP BY source, k),
c AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY md5('mix|' || coalesce(source, '<null>') || '|' || k[:2]), k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q),
j AS (SELECT keyed.*, source_size, target, passes, target - passes * source_size AS rest,
             CASE WHEN before + words <= target - passes * source_size THEN 1 ELSE 0 END AS more
      FROM keyed JOIN c ON keyed.k = c.k AND keyed.source IS NOT DISTINCT FROM c.source JOIN s5 ON keyed.source IS NOT DISTINCT FROM s5.source),
gaps AS (SELECT source, max(rest) - sum(size * more) AS gap FROM j GROUP BY source),
fits AS (SELECT j.source, arg_min(k, (abs(gap - size), k)) AS fit FROM j JOIN gaps ON j.source IS NOT DISTINCT FROM gaps.source
         WHERE more = 0 AND size > 0 AND abs(gap - size) < gap GROUP BY j.source),
b0 AS (SELECT source, k[:2] AS b, sum(size) AS words FROM keyed GROUP BY source, k[:2]),
b1 AS (SELECT *, coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER o AS i,
              count(*) OVER (PARTITION BY source) AS n
       FROM b0 WINDOW o AS (PARTITION BY source ORDER BY md5('mix|' || coalesce(source, '<null>') || '|' || b))),
b2 AS (SELECT b1.*, CASE WHEN b1.source IS NULL THEN 'null' ELSE '=' || b1.source END AS s,
              passes + CASE WHEN before + words > target - passes * source_size AND before >= target - passes * source_size THEN 0 ELSE 1 END AS times
       FROM b1 JOIN s5 ON b1.source IS NOT DISTINCT FROM s5.source),
t0 AS (SELECT 0 AS shard, s, sum(times)::BIGINT AS quota FROM b2 GROUP BY s),
""" + "".join(f"""d{i} AS (SELECT shard, s, unnest(generate_series(1, quota)) AS i FROM t{i}),
h{i} AS (SELECT s, shard * 2 + CASE WHEN 2 * row_number() OVER (PARTITION BY shard ORDER BY md5('mix|{i}|' || shard || '|' || s || '|' || i))
                <= count(*) OVER (PARTITION BY shard) + shard % 2 THEN 0 ELSE 1 END AS shard FROM d{i}),
t{i + 1} AS (SELECT shard, s, count(*) AS quota FROM h{i} GROUP BY shard, s),
""" for i in range(4)) + r"""turns AS (SELECT s, shard, row_number() OVER (PARTITION BY s ORDER BY shard) - 1 AS turn FROM h3),
draws AS (SELECT b2.source, b2.b, list(shard ORDER BY turn) AS draws FROM turns JOIN b2 ON turns.s = b2.s AND turn % n + 1 = b2.i GROUP BY b2.source, b2.b),
z AS (SELECT j.*, coalesce(draws, []) AS draws, (passes + CASE WHEN k = fit THEN 1 ELSE more END)::BIGINT AS copies
      FROM j LEFT JOIN fits ON j.source IS NOT DISTINCT FROM fits.source LEFT JOIN draws ON j.source IS NOT DISTINCT FROM draws.source AND k[:2] = draws.b)
SELECT doc_id, size, source_size, target, size * copies AS taken,
       array_to_string(list_concat(draws[1:copies], CASE WHEN copies > len(draws) THEN [('0x' || k[5:8])::BIGINT % 16] ELSE [] END), ',') AS shards
FROM z""")
def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    shards = F.transform(F.array_sort("places"), lambda p: p["shard"].cast("string"))
    return mix_sources(read(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.array_join(shards, ",").alias("shards"))


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS win
      FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM i),
spots AS (SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT doc_id, item_id, s, spots.size AS size FROM spots JOIN i ON spots.win = i.win AND spots.size = i.size),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""")
def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    out = contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"), length=13, one_in=20)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query()
def op7_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_groups(read(spark, sf, "documents"), words=2, percent=80)


@query()
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(read(spark, sf, "documents"), per_label=400).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op5_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(read(spark, sf, "pages"))


@query()
def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = drop_repeated_lines(read(spark, sf, "documents"), percent=80)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, lo) AS pre, substr(t, lo + 1, hi - lo) AS mid, substr(t, hi + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""")
def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query()
def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read(spark, sf, "embeddings"), components=32)


@query(r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op13_exact_search(spark: SparkSession, sf: str) -> DataFrame:
    return top_scores(read(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
