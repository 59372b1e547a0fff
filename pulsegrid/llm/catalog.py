"""Registered queries of the training-data operators: each applies its operator
with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.llm import (cuckoo_dedup, decontaminate, filter_audit, golay_simhash, importance, line_dedup, lm_score, lpf_dedup, pieces,
                           rmq_search, scaled_sketch, toxicity, url_equivalence)
from pulsegrid.llm.common import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_log_bilinear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the unigram base and the model."""
    return lm_score.score(read_table(spark, sf_dir, "documents"))


# fixed values: the rules of the query's contract
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


@query
def op2_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by rules and redirect equivalence."""
    return url_equivalence.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


# exact where no page declares a canonical or refresh target, as in the given
# tables; the propagation itself is tested against brute force
ORACLES["op2_url_equivalence"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS r FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(kind, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                             ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, host, path, h || rules.p AS rule, kind,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || rules.p) DESC NULLS LAST) AS n
  FROM q LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p))
SELECT page_id, host, path, rule, coalesce(kind, 'allow') AS verdict FROM fit WHERE n = 1
"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what line deduplication removes and the digest of the rest."""
    r = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), min_words=1)
    gone = F.aggregate("removed_spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    t = F.coalesce("kept_text", F.lit("")).cast("binary")
    return r.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        F.size("removed_spans").cast("bigint").alias("n_removed"), gone.alias("n_removed_bytes"),
        F.array_join(F.transform("removed_spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed_spans"),
        F.sha2(t, 256).alias("kept_sha256"))


# units of the whole documents table; offsets are counted in UTF-8 bytes
ORACLES["op3_line_dedup"] = """
WITH parts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, i, p[i] AS line, i < len(p) AS more,
         coalesce(list_sum(list_transform(p[1:i-1], lambda x: strlen(x) + 1)), 0) AS s
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
words AS (
  SELECT doc_id, i, s, line, s + strlen(line) + CASE WHEN more THEN 1 ELSE 0 END AS e,
         list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM lines WHERE line <> ''),
units AS (SELECT doc_id, i, s, e, array_to_string(w, ' ') AS u FROM words WHERE len(w) >= 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY doc_id, i) AS r FROM units),
gone AS (
  SELECT doc_id, count(*) AS n, sum(e - s) AS n_bytes, string_agg(CAST(s AS BIGINT) || '-' || CAST(e AS BIGINT), ',' ORDER BY s) AS spans
  FROM ranked WHERE r > 1 GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(l.line || CASE WHEN l.more THEN chr(10) ELSE '' END, '' ORDER BY l.i) AS t
  FROM lines l LEFT JOIN (SELECT doc_id, i FROM ranked WHERE r > 1) g ON l.doc_id = g.doc_id AND l.i = g.i
  WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CAST(strlen(coalesce(d.text, '')) AS BIGINT) AS n_bytes, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(g.n_bytes, 0) AS BIGINT) AS n_removed_bytes, coalesce(g.spans, '') AS removed_spans, sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query
def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return pieces.encode(read_table(spark, sf_dir, "documents"))


@query
def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return golay_simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query
def op6_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return cuckoo_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


ORACLES["op6_cuckoo_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a test item."""
    r = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return r.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                    decontaminate.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op8_decontaminate"] = r"""
WITH norm AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
  WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM norm WHERE kind = 'b' AND len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT id AS doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM norm WHERE kind = 'd'), sizes WHERE i + n - 1 <= len(w)),
hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN wins v ON g.n = v.n AND g.s = v.s),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
  (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS l
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN marked m ON id = m.doc_id LEFT JOIN items t ON id = t.doc_id WHERE kind = 'd'
"""


@query
def op9_importance_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document and whether Gumbel top-k draws it."""
    return importance.importance(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op10_lpf_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document under 400-byte strings that start elsewhere too."""
    r = lpf_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"), length=400, keep="none")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return r.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
                    removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                    F.sha2("kept_bytes", 256).alias("kept_sha256"))


# hex digits stand for the bytes: 800 digits are 400 bytes
ORACLES["op10_lpf_substring_dedup"] = """
WITH x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substring(h, 2 * i + 1, 800)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM x WHERE length(h) >= 800)),
d AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM d),
b AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i - p > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM g),
spans AS (SELECT doc_id, n, min(i) AS s, max(i) + 400 AS e FROM b GROUP BY doc_id, n),
gaps AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS a FROM spans),
kept AS (SELECT g.doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last,
                string_agg(substring(h, 2 * a + 1, 2 * (s - a)), '' ORDER BY s) AS left_over
         FROM gaps g JOIN x ON g.doc_id = x.doc_id GROUP BY g.doc_id)
SELECT x.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(left_over || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM x LEFT JOIN kept k ON x.doc_id = k.doc_id
"""


@query
def op11_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return scaled_sketch.neighbours(read_table(spark, sf_dir, "documents"))


@query
def op12_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rmq_search.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


ORACLES["op12_rmq_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
a AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM n),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY 1, 2),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL),
f AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), a),
s AS (SELECT item_id, p.doc_id,
             CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l)))) AS BIGINT) AS score
      FROM q JOIN p ON q.t = p.t JOIN f ON f.t = p.t JOIN n ON n.doc_id = p.doc_id, a GROUP BY 1, 2)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 10
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of every order of five filters removes, by language."""
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda z: z <> '') AS ws,
             min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
f AS (SELECT doc_id, part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
             100 * (length(x) - length(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(x) AS c,
             regexp_matches(x, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels
      WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
             CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS mask,
             count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY 1, 2),
letters(v) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT concat(p.v, q.v, r.v, s.v, u.v) AS o FROM letters p, letters q, letters r, letters s, letters u
           WHERE len(list_distinct([p.v, q.v, r.v, s.v, u.v])) = 5),
steps AS (SELECT o, k AS step, substring(o, k, 1) AS f, substring(o, 1, k - 1) AS before
          FROM orders, (SELECT unnest(range(1, 6)) AS k)),
g AS (SELECT part, o, step, f, n, good, toxic, contains(mask, f) AS fails,
             mask <> '' AND translate(mask, before, '') <> mask AS gone, mask = f AS alone FROM m, steps),
r AS (SELECT part, o, step, f, sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
             sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (alone) AS unique_fails,
             sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost
      FROM g GROUP BY part, o, step, f)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM r
"""
