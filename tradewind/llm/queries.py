"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    importance, language_id, lexical_search, mixing, near_duplicates, packing, personal_data, quality_rules, source_divergence,
    substring, suffix_dedup, topk_search, toxicity,
)
from tradewind.session import input_files, widen

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; the session's shuffles are wide enough for it from now on."""
    path = f"{folder}/{name}.parquet"
    widen(spark, sum(size for _, size, _ in input_files(spark, path)))
    return spark.read.parquet(path)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, folder, "documents"), vocabulary())


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


@query
def op4_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Towards the documents labelled good; as many as the labels' share of good ones."""
    labels = table(spark, folder, "labels")
    good = labels.filter("quality = 1 AND toxic = 0")
    return importance.resample(table(spark, folder, "documents"), good, importance.labelled_share(labels))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_languages(table(spark, folder, "documents"))


@query
def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk_search.top_inner_products(vectors, F.col("vec_id") % 20 == 0)


@query
def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


SQL["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


@query
def op6_super_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), words=2, percent=80)


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.substring_dedup(table(spark, folder, "documents"))


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, folder, "documents"))


@query
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


@query
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, folder, "documents"))


SQL["op12_source_divergence"] = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(any_value(v.n), 0) AS n_lang, coalesce(sum(c.c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY lang, source, v
), p AS (
  SELECT lang, source, term, c.c AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 1) // (g.n + g.v) AS p,
    1 + 1000000000 * (kept.c + 1) // (g.n_lang + g.v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
), sums AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY lang, a.source, b.source
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 200
"""


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op11_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS doc,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), size AS (SELECT doc, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0
), total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size
), tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM d) GROUP BY doc, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scores AS (
  SELECT item_id, doc_id, doc, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN size USING (doc), total GROUP BY item_id, doc_id, doc
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
) WHERE rank <= 50
"""


@query
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
