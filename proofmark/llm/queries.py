"""The operators of this subpackage over the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark.llm import (
    alignment, column_bwt, entropy_secrets, fim_fenwick, host_rules, maxent, mixing, packing, pq_links, rlz_spans, simhash_trees, simple8b,
    suffix_arrays, tokens,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query()
def op1_hashed_maxent(spark, sf_dir):
    return maxent.score(documents(spark, sf_dir))


HOST_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM starts),
again AS (SELECT r, x FROM windows GROUP BY r, x HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN again USING (r, x), range(3) AS three(k) GROUP BY r),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (r)),
j AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m),
s AS (
  SELECT *, 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * len(lines) OR word_chars < 3 * n_words
    OR word_chars > 10 * n_words AS strict_failed
  FROM j),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR strict_failed) AS f FROM s GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS var FROM h),
q AS (SELECT mean, CASE WHEN var > mean * (1 - mean) * 1e-9 THEN greatest(mean * (1 - mean) / var - 1, 0) END AS prior FROM p),
v AS (SELECT source, coalesce((f + mean * prior) / (n + prior), mean) > 0.5 AS host_failed FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (host_failed AND strict_failed) AS kept, host_failed
FROM s JOIN v ON s.source IS NOT DISTINCT FROM v.source
"""


@query(HOST_SQL)
def op3_host_rules(spark, sf_dir):
    return host_rules.judge(documents(spark, sf_dir))


def _found_sql(rank: int, pattern: str, group: int = 0, least: int = 0) -> str:
    """Matches of a pattern with their code points; the gaps between them come from a split by it."""
    text = pattern.replace("'", "''")
    return f"""
    SELECT r, {rank} AS k, f[i] AS piece, start, start + len(f[i]) AS stop FROM (
      SELECT r, f, i, (list_sum(list_transform(g[1:i], lambda x: len(x)))
        + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: len(x))), 0))::BIGINT AS start
      FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
        SELECT r, regexp_extract_all(body, '{text}') AS f, string_split_regex(body, '{text}') AS g FROM d)))
    WHERE len(regexp_extract(f[i], '{text}', {group})) >= {least}"""


_allowed_sql = "(" + " OR ".join(f"regexp_matches(piece, '{p}')" for p in entropy_secrets.ALLOW[:2]) + ")"

SECRET_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
base AS ({_found_sql(0, entropy_secrets.ASSIGN, 1, entropy_secrets.ASSIGN_VALUE)}
  UNION ALL {_found_sql(1, entropy_secrets.ACCESS)} UNION ALL {_found_sql(2, entropy_secrets.HEX)}),
candidates AS ({_found_sql(3, "[A-Za-z0-9+/_=-]{20,}")}),
parts AS (
  SELECT r, g[i] AS piece, (start + coalesce(list_sum(list_transform(g[1:i - 1] || f[1:i - 1], lambda x: len(x))), 0))::BIGINT AS start
  FROM (SELECT *, unnest(range(1, len(g) + 1)) AS i FROM (
    SELECT r, start, string_split_regex(piece, '{entropy_secrets.PLACEHOLDER}') AS g,
      regexp_extract_all(piece, '{entropy_secrets.PLACEHOLDER}') AS f
    FROM candidates WHERE regexp_matches(piece, '[0-9]') AND regexp_matches(piece, '[A-Za-z]') AND NOT {_allowed_sql}))),
windows AS (
  SELECT r, start, piece, unnest(range(0, len(piece) - 19)) AS w,
    CASE WHEN regexp_matches(piece, '^([0-9a-f]+|[0-9A-F]+)$') THEN {entropy_secrets.HEX_BITS} ELSE {entropy_secrets.ANY_BITS} END AS bits
  FROM parts WHERE len(piece) >= 20 AND NOT {_allowed_sql}),
hot AS (SELECT * FROM windows WHERE list_entropy(string_split(substr(piece, w + 1, 20), '')) >= bits - 1e-10),
edges AS (SELECT *, w > 20 + coalesce(lag(w) OVER (PARTITION BY r, start ORDER BY w), -99) AS new FROM hot),
islands AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY r, start ORDER BY w) AS island FROM edges),
runs AS (SELECT r, 3 AS k, start + min(w) AS start, start + max(w) + 20 AS stop FROM islands GROUP BY r, island, islands.start),
spans AS (
  SELECT r, k, start, stop FROM base
  UNION ALL SELECT r, k, start, stop FROM runs
  WHERE NOT EXISTS (FROM base WHERE base.r = runs.r AND base.start <= runs.start AND runs.stop <= base.stop)),
listed AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(name, ',' ORDER BY start, k) FILTER (k < 3) AS base_spans, string_agg(name, ',' ORDER BY start, k) AS spans
  FROM (SELECT *, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || start || ':' || stop AS name FROM spans) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""


@query(SECRET_SQL)
def op10_entropy_secrets(spark, sf_dir):
    return entropy_secrets.scan(documents(spark, sf_dir))


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER by_limit AS rank, sum(source_size) OVER () AS total,
    coalesce(sum(2 * source_size) OVER (by_limit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(w) OVER () - coalesce(sum(w) OVER (by_limit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
  FROM s WINDOW by_limit AS (ORDER BY 2 * source_size / w, source NULLS LAST)),
l AS (SELECT *, (1.5::DOUBLE * total::DOUBLE - used::DOUBLE) / w_left::DOUBLE AS level FROM o),
h AS (SELECT *, 2 * source_size <= level * w AS held FROM l),
t0 AS (
  SELECT source, source_size,
    CASE WHEN held THEN (2 * source_size)::DOUBLE ELSE (SELECT arg_min(level, rank) FROM h WHERE NOT held) * w END AS target
  FROM h),
t1 AS (SELECT *, least(floor(target + 0.5), 2 * source_size)::BIGINT AS need, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM t0),
t AS (
  SELECT *, (sum(need) OVER ())::BIGINT AS whole, (sum(need) OVER (ORDER BY s))::BIGINT AS upto FROM t1),
points AS (
  SELECT i, (i + 1) * 0.6180339887498949::DOUBLE - floor((i + 1) * 0.6180339887498949::DOUBLE) AS x
  FROM range((SELECT (max(whole) + 1023) // 1024 FROM t)) AS r(i)),
hit AS (
  SELECT s, need, i AS slot, row_number() OVER (PARTITION BY s ORDER BY i) - 1 AS rank
  FROM points JOIN t ON x >= (upto - need)::DOUBLE / greatest(whole, 1)::DOUBLE AND x < upto::DOUBLE / greatest(whole, 1)::DOUBLE),
missed AS (
  SELECT s, unnest(range((SELECT count(*) FROM hit WHERE hit.s = t.s), (need + 1023) // 1024)) AS rank FROM t),
slots AS (
  SELECT s, rank, slot FROM hit WHERE rank * 1024 < need
  UNION ALL SELECT s, rank, (SELECT count(*) FROM points) + row_number() OVER (ORDER BY rank, s) - 1 FROM missed),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, need, s,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, need) - start)
   + greatest(0, least(start + source_size + size, need) - start - source_size))::BIGINT AS taken,
  CASE WHEN size > 0 AND start < need THEN slot END::BIGINT AS slot
FROM p LEFT JOIN slots ON slots.s = p.s AND slots.rank = p.start // 1024
"""


@query(MIX_SQL)
def op2_golden_mix(spark, sf_dir):
    return mixing.plan(documents(spark, sf_dir))


@query()
def op4_simhash_trees(spark, sf_dir):
    return simhash_trees.label(documents(spark, sf_dir))


@query()
def op8_deficit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query()
def op9_simple8b(spark, sf_dir):
    return simple8b.read(simple8b.write(documents(spark, sf_dir)))


SPAN_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS x FROM starts),
again AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN again USING (x), range(35) AS t(j)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(counts.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query(SPAN_SQL)
def op5_rlz_spans(spark, sf_dir):
    return rlz_spans.dedup(documents(spark, sf_dir))


LINK_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counts.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(least.b, e.vec_id)) AS kept
FROM embeddings AS e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
"""


@query(LINK_SQL)
def op6_pq_links(spark, sf_dir):
    return pq_links.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query()
def op7_column_bwt(spark, sf_dir):
    return column_bwt.dedup(documents(spark, sf_dir))


@query()
def op11_galloping_alignment(spark, sf_dir):
    return alignment.align(documents(spark, sf_dir), tokens.path("byte_bpe_50k.json"), tokens.path("piece_bpe_32k.model"))


_WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

BENCHMARK_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT row_number() OVER () AS k, coalesce(item_id::VARCHAR, '') AS item, {_WORDS_SQL} AS w FROM benchmark),
windows AS (
  SELECT k, item, x, n, array_to_string(w[x : x + n - 1], ' ') AS s FROM (
    SELECT *, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS x FROM i WHERE len(w) > 0)),
starts AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n),
m AS (
  SELECT r, p, k, x, item, n FROM (SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS s FROM starts) JOIN windows USING (n, s)),
hits AS (SELECT r, count(DISTINCT p + j) AS n_hit FROM m JOIN range(10) AS t(j) ON j < n GROUP BY r),
listed AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY r),
chains AS (SELECT r, n, p - row_number() OVER (PARTITION BY r, k, p - x ORDER BY p) AS chain, k, p - x AS shift FROM m),
longest AS (SELECT r, max(c) AS longest FROM (SELECT r, count(*) + any_value(n) - 1 AS c FROM chains GROUP BY r, k, shift, chain) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(longest, 0)::BIGINT AS longest
FROM d LEFT JOIN hits USING (r) LEFT JOIN listed USING (r) LEFT JOIN longest USING (r)
"""


@query(BENCHMARK_SQL)
def op12_suffix_arrays(spark, sf_dir):
    found = suffix_arrays.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "longest",
    )


FIM_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u
  FROM documents),
cut AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50
      THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT *, array_to_string(u[1 : least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS mid,
    array_to_string(u[greatest(a, b) + 1 :], '') AS suf
  FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM parts
"""


@query(FIM_SQL)
def op13_fenwick_fim(spark, sf_dir):
    out = fim_fenwick.transform(documents(spark, sf_dir))
    digest = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fim_fenwick.restored(), 256).alias("restored_sha256")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)
