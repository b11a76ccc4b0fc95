"""Exact dedup by progressive refinement: by length, then a prefix's hash, then the whole text's hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.llm import common

def normalised(text: str) -> Column:
    """Null as empty, every run of ``[\\x20\\x09-\\x0D]`` as one space."""
    # Single spaces, the bulk of all runs, already are what they become.
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 128, digest: bool = False, keyed: bool = False) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and, with ``digest``, ``text_sha256``.

    Rows are equal when their normalised texts are (see ``normalised``). The first pass groups all rows by
    length and hash of a prefix; the second pass hashes the whole text only of rows whose pair of these
    more than one row has, and groups them by the hash. Which rows these are is read off a bitmap, broadcast,
    which is sized by the number of such pairs (``common.Bitmap``): texts are never shuffled, and a false hit
    costs one hash. ``digest`` asks for the
    hash of every row.

    Null texts count as empty; empty texts are equal to each other. Null ids come after all others. Of rows
    with the same text and the same smallest id exactly one is kept. Other columns, whatever their names,
    are not read. An empty table gives an empty result.
    """
    norm = normalised(text_col)
    key = common.row_key(id_col, text_col) if keyed else F.lit(None).cast("string")
    sized = docs.select(F.col(id_col).alias("__id"), key.alias("__key"), norm.alias("__norm")).select(
        "__id", "__key", "__norm", F.length("__norm").alias("__len"), F.xxhash64(F.length("__norm"), F.substring("__norm", 1, prefix_chars)).alias("__pre")
    )
    several = sized.groupBy("__len", "__pre").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__pre").distinct()
    marked = common.Bitmap(common.staged(several, "exact-several")).mark(sized, "__pre", "__hit")
    whole = F.unhex(F.sha2(F.col("__norm"), 256))
    rows = common.staged(
        marked.select("__id", "__key", "__len", "__hit", F.when(F.lit(digest) | F.col("__hit"), whole).alias("__sha"), F.monotonically_increasing_id().alias("__at")),
        "exact-rows",
    )
    first = F.min(F.struct(F.col("__id").isNull().alias("null"), F.col("__id").alias("id"), F.col("__at").alias("at")))
    groups = (
        rows.filter("__hit").groupBy("__len", "__sha").agg(first.alias("__first"), F.count(F.lit(1)).alias("__size"))
        .filter("__size > 1").select("__len", "__sha", "__size", F.col("__first.id").alias("__keep"), F.col("__first.at").alias("__keep_at"))
    )
    groups = common.staged(groups, "exact-groups")
    found = common.lookup(rows, groups, ["__len", "__sha"], "__size", rows.count())
    grouped = F.col("__size").isNotNull()
    out = [
        F.col("__id").alias(id_col),
        F.when(grouped, F.col("__keep")).otherwise(F.col("__id")).alias("keep_id"),
        F.coalesce(F.col("__size"), F.lit(1).cast("long")).alias("group_size"),
        (~grouped | (F.col("__keep_at") == F.col("__at"))).alias("kept"),
    ]
    more = [F.lower(F.hex("__sha")).alias("text_sha256")] if digest else []
    return found.select(*out, *more, *([F.col("__key").alias("key")] if keyed else []))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``exact_dedup`` keeps: one of each group of equal texts."""
    return common.rows_kept(docs, exact_dedup(docs, id_col, text_col, keyed=True), id_col, text_col)
