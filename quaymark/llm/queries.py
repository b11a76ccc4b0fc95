"""The thin queries ``opN_<name>``: each applies its operator to a whole table and derives the contract's columns."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.llm import exact_dedup as exact
from quaymark.llm import common, html_main_text, lexicon_bpe, lm_scoring, packing, prefix_counts, quality_crf, simhash, tokenizers_used, url_filter, vector_graph


def _whole(name: str):
    """A query whose result is staged, so that nothing else that it staged is left."""

    def wrap(query):
        @functools.wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return common.finished(lambda: query(spark, sf_dir), name)

        return run

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Score from which on a document is good.
GOOD = 0.7


def quality_field(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_crf.Field:
    """The quality field fitted on labelled rows outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").filter(common.crc32_of("doc_id") % 4 != 2)
    return quality_crf.train(docs, labels)


@_whole("op1_quality_crf")
def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality_crf.score(docs, quality_field(spark, docs, sf_dir))
    held = F.coalesce(common.crc32_of("doc_id") % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@_whole("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_whole("op3_lexicon_bpe")
def op3_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon_bpe.encode(_table(spark, sf_dir, "documents"), vocabulary="word_bpe_49k.json", whole=False)


@_whole("op4_context_mixing")
def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"), common.crc32_of("doc_id") % 7 == 2)


@_whole("op5_vector_graph")
def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vector_graph.search(vector_graph.build_index(vectors), vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@_whole("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizers_used.byte_bpe(), size=2048, end_id=0)


#: The contract's rules.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])


def op8_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.token_counts(_table(spark, sf_dir, "documents"), limit=4096)


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main_text.main_text(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


@_whole("op10_exact_dedup")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents"), digest=True)


QUERIES = {
    "op1_quality_crf": op1_quality_crf,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_lexicon_bpe": op3_lexicon_bpe,
    "op4_context_mixing": op4_context_mixing,
    "op5_vector_graph": op5_vector_graph,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_url_filter": op7_url_filter,
    "op8_prefix_token_counts": op8_prefix_token_counts,
    "op9_html_main_text": op9_html_main_text,
    "op10_exact_dedup": op10_exact_dedup,
}

ORACLE_SQL = {
    "op7_url_filter": r"""
        WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
             p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
             r(verdict, rule, rhost, rpath) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                          ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
             m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN r
                   ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
        SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)""",
}
