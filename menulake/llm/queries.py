"""Queries of the corpus operators over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from menulake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.common import Tables
    from menulake.llm.token_files import read_tokens, write_tokens
    path = Tables(spark, "tokens").root
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, digest=True)


@query
def op10_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.extract_text import extract_text
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.mix import mix
    return mix(table(spark, sf_dir, "documents"))


@query
def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.line_quality import line_quality
    return line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.near_copies import near_copies
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.url_list import dated_captures, dated_entries, judge
    pages = table(spark, sf_dir, "pages")
    return judge(dated_captures(pages), dated_entries(pages))


ORACLES["op9_url_list"] = r"""
WITH captures AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(((page_id % 365) + 365) % 365 AS INTEGER) AS TIMESTAMP) AS fetched_at,
    nullif(regexp_replace(lower(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
    regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL
), hyphens AS (
  SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 2, 1), len(string_split(host, '.'))), '.') AS host
  FROM hosts WHERE host LIKE '%-%'
), entries AS (
  SELECT host AS pattern, 'block' AS action, TIMESTAMP '2024-02-01' AS valid_from FROM hosts WHERE length(host) % 3 = 0
  UNION SELECT host, 'drop', TIMESTAMP '2024-06-01' FROM hosts WHERE length(host) % 3 = 0
  UNION SELECT host, 'block', TIMESTAMP '2024-10-01' FROM hosts WHERE length(host) % 3 = 0
  UNION SELECT host, 'block', TIMESTAMP '2024-04-01' FROM hosts WHERE length(host) % 3 = 1
  UNION SELECT host || '/en', 'allow', TIMESTAMP '2024-08-01' FROM hosts WHERE length(host) % 3 = 1
  UNION SELECT host, 'block', TIMESTAMP '2024-01-01' FROM hyphens
), one AS (
  SELECT pattern, valid_from, arg_min(action, CASE action WHEN 'block' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS action
  FROM entries GROUP BY pattern, valid_from
), spans AS (
  SELECT pattern, action, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from), TIMESTAMP '9999-12-31') AS valid_to FROM one
), met AS (
  SELECT c.page_id, c.url, c.fetched_at, s.pattern, s.action, s.valid_from,
    row_number() OVER (PARTITION BY c.page_id, c.url, c.fetched_at ORDER BY length(s.pattern) DESC, s.pattern DESC) AS rn
  FROM captures c JOIN spans s
    ON (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)
        OR starts_with(c.host || regexp_replace(c.path, '/+', '/', 'g') || '/', s.pattern || '/') AND contains(s.pattern, '/'))
   AND s.action <> 'drop' AND s.valid_from <= c.fetched_at AND c.fetched_at < s.valid_to
)
SELECT c.page_id, c.url, c.fetched_at, m.pattern, m.action, m.valid_from, coalesce(m.action = 'block', FALSE) AS blocked
FROM captures c LEFT JOIN met m ON m.rn = 1 AND c.page_id = m.page_id AND c.url = m.url AND c.fetched_at = m.fetched_at
"""


def _template_sql(table: str, key: str) -> str:
    """Windows of five template words of a table: key, pos, win, vals (the values of its slots)."""
    from menulake.llm.decontaminate import UNITS
    units = ", ".join(f"'{u}'" for u in UNITS)
    marks = "concat(chr(10), coalesce(text, ''))"
    joined = f"regexp_replace(regexp_replace({marks}, '([0-9])[.,]([0-9])', '\\1\\2', 'g'), '([0-9])[.,]([0-9])', '\\1\\2', 'g')"
    spaced = f"regexp_replace({joined}, '([0-9])(\\p{{L}})', '\\1 \\2', 'g')"
    return f"""
  SELECT k, unnest(range(1, len(w) - 3)) AS pos, w, t FROM (
    SELECT k, w, list_transform(w, lambda x, i: CASE
        WHEN dg AND coalesce(substr(w[i - 1], 1, 1) BETWEEN '0' AND '9', FALSE) AND i > 1 AND lower(x) IN ({units}) THEN '#unit'
        WHEN substr(x, 1, 1) BETWEEN 'a' AND 'z' THEN lower(x)
        WHEN substr(x, 1, 1) = chr(1) THEN lower(substr(x, 2))
        WHEN dg AND substr(x, 1, 1) BETWEEN '0' AND '9' THEN '#number'
        WHEN regexp_matches(x, '^\\p{{Lu}}\\p{{Ll}}') THEN '#name' ELSE lower(x) END) AS t
    FROM (
      SELECT {key} AS k, regexp_matches(coalesce(text, ''), '[0-9]') AS dg,
        list_filter(string_split_regex(regexp_replace(CASE WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN {spaced} ELSE {marks} END,
          '([.!?:\\n][ \\t\\r\\n"''(]*)(\\p{{Lu}})', concat('\\1', chr(1), '\\2'), 'g'), '[^\\p{{L}}\\p{{N}}\\x01]+'), lambda x: x <> '') AS w
      FROM {table} WHERE {key} IS NOT NULL))"""


def _decontaminate_sql() -> str:
    slots = "list_filter(range(pos, pos + 5), lambda j: starts_with(t[j], '#'))"
    vals = f"list_transform({slots}, lambda j: lower(w[j]))"
    wins = f"SELECT k, pos, array_to_string(list_slice(t, pos, pos + 4), ' ') AS win, {vals} AS vals"
    return f"""
WITH d AS ({wins} FROM ({_template_sql("documents", "doc_id")})),
i AS (SELECT DISTINCT * FROM ({wins} FROM ({_template_sql("benchmark", "item_id")})) WHERE len(vals) <= 2),
total AS (SELECT k AS item_id, count(DISTINCT pos) AS n_windows FROM i GROUP BY k),
hits AS (SELECT d.k AS doc_id, i.k AS item_id, i.pos AS item_pos, d.pos - i.pos AS shift, i.vals AS iv, d.vals AS dv FROM d JOIN i ON d.win = i.win),
slots AS (SELECT DISTINCT doc_id, item_id, shift, unnest(iv) AS a, unnest(dv) AS b FROM hits),
bad AS (SELECT doc_id, item_id, shift FROM slots GROUP BY ALL HAVING count(DISTINCT a) <> count(*)),
good AS (SELECT * FROM hits ANTI JOIN bad USING (doc_id, item_id, shift)),
found AS (SELECT doc_id, item_id, count(DISTINCT item_pos) AS n_found FROM good GROUP BY ALL),
pairs AS (SELECT doc_id, item_id, count(*) AS n_slots, bool_and(a = b) AS same_values
  FROM (SELECT DISTINCT doc_id, item_id, a, b FROM slots ANTI JOIN bad USING (doc_id, item_id, shift)) GROUP BY ALL)
SELECT doc_id, item_id, n_windows, n_found, coalesce(n_slots, 0) AS n_slots, coalesce(same_values, TRUE) AS same_values
FROM found JOIN total USING (item_id) LEFT JOIN pairs USING (doc_id, item_id)
WHERE n_found >= 0.8 * n_windows OR n_found >= 9"""


ORACLES["op6_decontaminate"] = _decontaminate_sql()


@query
def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.surrogates import replace_personal_data
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, key="menulake-query")


@query
def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.near_vectors import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op11_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.top_scores import top_scores
    return top_scores(table(spark, sf_dir, "embeddings"))


ORACLES["op11_top_scores"] = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.n, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.n <> b.n
)
SELECT query_id, (row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.filter_audit import filter_audit
    return filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
    concat(CASE WHEN len(w) < 50 THEN 'A' ELSE '' END,
           CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
           CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN l USING (doc_id)
), counted AS (
  SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM failed GROUP BY ALL
), f(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT concat(a.c, b.c, x.c, y.c, z.c) AS filter_order FROM f a, f b, f x, f y, f z
  WHERE len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5
), steps AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before FROM orders, range(1, 6) t(step)
), met AS (
  SELECT part, filter_order, step, own, fails, n, good, toxic, contains(fails, own) AS fails_own,
    len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND before <> '' AND fails <> '' AS gone
  FROM counted, steps
), report AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT gone AND NOT fails_own THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND fails_own THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND fails_own THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND fails_own THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND fails_own THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM report"""


@query
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from menulake.llm.importance_resample import importance_resample
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
