"""The operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from tallybook.llm import decontaminate, licenses, mixing, neighbours, ngram_join, page_text, periodic_runs, personal_data, secrets, spelling, sql, substrings, toxicity, url_filter
from tallybook.llm.tables import documents


def op1_ngram_join(spark, sf_dir):
    return ngram_join.ngram_components(documents(spark, sf_dir))


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op3_url_filter(spark, sf_dir):
    return url_filter.judged(documents(spark, sf_dir, "pages"))


def op4_page_text(spark, sf_dir):
    return page_text.main_text(documents(spark, sf_dir, "pages"))


def op5_neighbours(spark, sf_dir):
    return neighbours.nearest(documents(spark, sf_dir, "embeddings"))


def op6_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op7_licenses(spark, sf_dir):
    return licenses.scan(licenses.with_paths(documents(spark, sf_dir)))


def op8_substrings(spark, sf_dir):
    return substrings.deduplicated(documents(spark, sf_dir)).drop("spans")


def op9_secrets(spark, sf_dir):
    return secrets.secret_spans(documents(spark, sf_dir))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.benchmark_hits(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark")).drop("spans")


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.periodic_runs(documents(spark, sf_dir)).drop("n_words", "runs")


def op12_personal_data(spark, sf_dir):
    return personal_data.personal_spans(documents(spark, sf_dir))


def op13_spelling(spark, sf_dir):
    return spelling.variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_toxicity, op3_url_filter, op4_page_text, op5_neighbours, op6_mixing, op7_licenses, op8_substrings, op9_secrets, op10_decontaminate, op11_periodic_runs, op12_personal_data, op13_spelling)}

_OP10 = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark),
win AS (
  SELECT item_id, least(len(ws), 10) AS k, unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2), lambda i: array_to_string(ws[i : i + 9], ' '))) AS g
  FROM b WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: {'i': i, 'g': array_to_string(ws[i : i + k - 1], ' ')})) AS x
  FROM w, ks WHERE len(ws) >= k),
hits AS (SELECT DISTINCT doc_id, item_id, x.i AS i, win.k AS k FROM grams JOIN win ON win.g = x.g AND win.k = grams.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
SQL: dict[str, str] = {
    "op1_ngram_join": sql.NGRAM_JOIN,
    "op8_substrings": sql.SUBSTRINGS,
    "op10_decontaminate": _OP10,
    "op11_periodic_runs": sql.RUNS,
    "op13_spelling": sql.SPELLING,
}
