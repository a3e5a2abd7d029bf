"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import (exact_dedup, language_id, line_quality, merkle, mixing, pii, quality_rules, sentencepiece, simhash, token_counts, toxicity,
               url_rules, vector_codes)
from .common import table

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# The deduplicating group of each document, as a common table expression.
EXACT_GROUPS = r"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       sha256(norm) AS text_sha256
FROM rows
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""


@register("op1_exact_dedup", EXACT_GROUPS)
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@register("op2_language_id")
def op2_language_id(spark, sf_dir):
    return language_id.language_report(table(spark, sf_dir, "documents"))


# One period of the schedule, step by step, and each document's slot from it.
MIXING = r"""
WITH RECURSIVE src AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT greatest(1000, 20 * count(*)) AS slots FROM src),
x AS (SELECT s, slots, slots * sqrt(n) / (SELECT sum(sqrt(n)) FROM src) AS x FROM src, r),
w AS (SELECT s, greatest(1, floor(x) + CASE WHEN row_number() OVER (ORDER BY floor(x) - x, s) <= slots - sum(floor(x)) OVER ()
                                            THEN 1 ELSE 0 END)::BIGINT AS a FROM x),
l AS (SELECT list(s ORDER BY s) AS names, list(a ORDER BY s) AS a, sum(a)::BIGINT AS p FROM w),
sim AS (
  SELECT 0::BIGINT AS slot, names, a, p, list_transform(a, lambda x: 0::BIGINT) AS nxt, 1::BIGINT AS pick FROM l
  UNION ALL
  SELECT slot + 1, names, a, p, list_transform(range(1, len(a) + 1), lambda i: nxt[i] + CASE WHEN i = chosen THEN 1 ELSE 0 END), chosen
  FROM (
    SELECT *, list_min(list_transform(range(1, len(a) + 1), lambda i:
        CASE WHEN nxt[i] < a[i] AND nxt[i] * p // a[i] <= slot
             THEN (((nxt[i] + 1) * p + a[i] - 1) // a[i]) * 1000000 + i END)) % 1000000 AS chosen
    FROM sim WHERE slot < p)),
plan AS (SELECT names[pick] AS s, a[pick] AS a, p, nxt[pick] - 1 AS j, slot - 1 AS turn FROM sim WHERE slot > 0),
d AS (SELECT doc_id, coalesce(source, '') AS s,
             row_number() OVER (PARTITION BY coalesce(source, '')
               ORDER BY (((doc_id % 2147483648) * 2654435761) % 4294967296
                         + ((doc_id >> 31) * 2246822519) % 4294967296) % 4294967296, doc_id) - 1 AS place FROM documents)
SELECT doc_id, d.s AS source, place // 8 AS block, ((place // 8) // a) * p + turn AS slot,
       (place // 8) * p // a AS release, ((place // 8 + 1) * p + a - 1) // a AS deadline, place
FROM d JOIN plan ON plan.s = d.s AND plan.j = (place // 8) % a
"""


@register("op3_source_mixing", MIXING)
def op3_source_mixing(spark, sf_dir):
    return mixing.mixing_plan(table(spark, sf_dir, "documents"))


@register("op4_personal_data")
def op4_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@register("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    return token_counts.answers(token_counts.length_histogram(table(spark, sf_dir, "documents")))


URL_RULES = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(rule, h, q, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (page_id)
"""


@register("op7_url_rules", URL_RULES)
def op7_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


@register("op8_sentencepiece")
def op8_sentencepiece(spark, sf_dir):
    return sentencepiece.encode_report(table(spark, sf_dir, "documents"))


@register("op9_line_quality")
def op9_line_quality(spark, sf_dir):
    return line_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_simhash_dedup")
def op10_simhash_dedup(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


# The tree level by level, then each document's siblings and the fold up.
MERKLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, source, lang, n_chars, text,
         list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS crc
  FROM documents),
f AS (SELECT doc_id, tree, (4294967295 - crc) % 3 = 0 AS hit,
             coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
      FROM d),
h AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN hit THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS changed
      FROM f),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM h),
low AS (
  SELECT 0 AS lvl, tree, idx, leaf AS node, n FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY lvl, tree, idx // 8, n),
subroots AS (SELECT tree, node AS subroot, lvl AS steps, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, subroot AS node, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n),
every AS (
  SELECT tree, lvl, idx, node FROM low WHERE n > 1
  UNION ALL
  SELECT s.tree, s.steps + t.lvl, t.idx, t.node FROM subroots s CROSS JOIN top t WHERE t.n > 1),
place AS (
  SELECT l.tree, l.idx AS leaf_idx, k.lvl, CASE WHEN k.lvl < s.steps THEN l.idx // (8 ** k.lvl)::BIGINT ELSE s.idx // (8 ** (k.lvl - s.steps))::BIGINT END AS idx
  FROM leaves l JOIN subroots s USING (tree) JOIN (SELECT DISTINCT tree, lvl FROM every) k USING (tree)),
step AS (
  SELECT p.tree, p.leaf_idx, p.lvl,
         coalesce(string_agg(e.node, '' ORDER BY e.idx) FILTER (e.idx < p.idx), '') AS before,
         coalesce(string_agg(e.node, '' ORDER BY e.idx) FILTER (e.idx > p.idx), '') AS after
  FROM place p JOIN every e ON e.tree = p.tree AND e.lvl = p.lvl AND e.idx // 8 = p.idx // 8 GROUP BY ALL),
proof AS (SELECT tree, leaf_idx, sha256(string_agg(before || after, '' ORDER BY lvl)) AS proof_sha256 FROM step GROUP BY ALL),
folded AS (
  SELECT tree, idx AS leaf_idx, 0 AS lvl, changed AS node FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_idx, f.lvl + 1, sha256(before || node || after) FROM folded f JOIN step s ON s.tree = f.tree AND s.leaf_idx = f.leaf_idx AND s.lvl = f.lvl),
ends AS (SELECT tree, leaf_idx, arg_max(node, lvl) AS folded_root FROM folded GROUP BY ALL)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.node AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN top r ON r.n = 1
JOIN ends e ON e.tree = l.tree AND e.leaf_idx = l.idx
LEFT JOIN proof p ON p.tree = l.tree AND p.leaf_idx = l.idx
"""


@register("op11_merkle_manifest", MERKLE)
def op11_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


@register("op12_toxicity")
def op12_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _codes_round(source: str, books: str, out: str) -> str:
    """Nearest entry of every part by plain distances."""
    return f"""
{out}_far AS (
  SELECT v.vec_id, v.label, v.p, v.ints, b.e, list_sum(list_transform(list_zip(v.ints, b.ints), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT AS far
  FROM {source} v JOIN {books} b USING (p)),
{out} AS (SELECT vec_id, any_value(label) AS label, p, any_value(ints) AS ints, arg_min(e, far * 64 + e) AS e, min(far) AS far FROM {out}_far GROUP BY vec_id, p)"""


def _codes_books(old: str, coded: str, out: str) -> str:
    return f"""
{out}_sum AS (
  SELECT p, e, i, floor(sum(ints[i])::HUGEINT / count(*))::BIGINT AS x FROM {coded}, range(1, 5) r(i) GROUP BY ALL),
{out} AS (
  SELECT b.p, b.e, coalesce(m.ints, b.ints) AS ints
  FROM {old} b LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS ints FROM {out}_sum GROUP BY ALL) m ON m.p = b.p AND m.e = b.e)"""


VECTOR_CODES = f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, ints[p * 4 + 1:p * 4 + 4] AS ints FROM v, range(16) r(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < 64),
b0 AS (SELECT p, e, ints FROM parts JOIN first USING (vec_id)),
{_codes_round('parts', 'b0', 'c0')},
{_codes_books('b0', 'c0', 'b1')},
{_codes_round('parts', 'b1', 'c1')},
{_codes_books('b1', 'c1', 'b2')},
{_codes_round('parts', 'b2', 'c2')},
coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM c2 GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(ints, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""


@register("op13_vector_codes", VECTOR_CODES)
def op13_vector_codes(spark, sf_dir):
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
