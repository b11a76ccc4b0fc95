"""The corpus pipeline: quality, exact copies, near copies, packing, in this order over ``documents``.

Each stage takes (spark, docs, sf_dir), docs being all that its predecessor kept, and all but the last return
whole rows of ``documents``. ``run`` writes what a stage returns to the shared folder and
reads it again; a stage's own tables, and its predecessor's, are deleted once it is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaymark.llm import common, exact_dedup, packing, quality_crf, queries, shingle_sets, tokenizers_used


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality field scores 0.7 or more."""
    field = queries.quality_field(spark, docs, sf_dir)
    return quality_crf.keep_good(docs, field, queries.GOOD)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 or more of 5-word shingles the row with the smallest id."""
    return shingle_sets.keep_first(docs, width=5, similarity=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizers_used.byte_bpe(), size=2048, end_id=0)


STAGES = [("quality", quality), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("pack", pack)]

#: The quality field, fingerprints and token ids are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs, held = common.finished(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}"), before
        before = docs
        if held is not None:  # read by the stage that is done now
            common.discard(held)
    return docs
