"""Reading tables: bounded ranges, pages by key, offsets, start positions, lag."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.plans.spec import TableSpec

from quaymark.operators.recon import live, range_filter


def range_scan(df: DataFrame, columns: list[str], key: str, low: Any = None, high: Any = None, include_deleted: bool = False, ordered: bool = True) -> DataFrame:
    """Columns of rows with a key in (low, high], in key order; filter and columns reach the files."""
    rows = df if include_deleted else live(df)
    out = rows.filter(range_filter(F.col(key), low, high)).select(*columns)
    return out.orderBy(key) if ordered else out


def keyset_page(df: DataFrame, key: str, limit: int, after: Any = None) -> DataFrame:
    """The next ``limit`` keys after one; no offset is counted off, each task keeps ``limit`` rows."""
    return df.filter(range_filter(F.col(key), after)).select(key).orderBy(key).limit(limit)


def bounded_count(df: DataFrame, key: str, low: Any = None, high: Any = None) -> DataFrame:
    return live(df).filter(range_filter(F.col(key), low, high)).agg(F.count(F.lit(1)).alias("row_count"))


def partitions(messages: DataFrame) -> DataFrame:
    """(``topic``, ``partition``) that a log has."""
    return messages.select("topic", "partition").distinct()


def unread(messages: DataFrame, stored: DataFrame, earliest: bool = True) -> DataFrame:
    """Messages after the stored offset of their place. A place without one starts at its first, or gives none yet.

    Offsets are a row per partition of a log; Spark broadcasts them if they are few.
    """
    joined = messages.join(stored.select("topic", "partition", "last_offset"), ["topic", "partition"], "left")
    start = F.coalesce("last_offset", F.lit(-1)) if earliest else F.col("last_offset")
    return joined.filter(F.col("offset") > start).drop("last_offset")


def consumer_lag(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """(``topic``, ``partition``, ``newest``, ``last_offset``, ``lag``) of each place."""
    newest = messages.groupBy("topic", "partition").agg(F.max("offset").alias("newest"))
    read = F.coalesce("last_offset", F.lit(-1).cast("long"))
    return newest.join(stored.select("topic", "partition", "last_offset"), ["topic", "partition"], "left").select("topic", "partition", "newest", read.alias("last_offset"), (F.col("newest") - read).alias("lag"))


def row_digests(df: DataFrame, key: str, digest, low: Any = None, high: Any = None) -> DataFrame:
    """(key, ``digest``) of a range, without tombstones where there are any."""
    rows = live(df).filter(range_filter(F.col(key), low, high))
    return rows.select(key, digest(rows).alias("digest"))


def extract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows of a planned table that are migrated: its declared columns, without what ``exclude`` (SQL) says. Null excludes nothing."""
    rows = df.filter(~F.coalesce(F.expr(spec.exclude), F.lit(False))) if spec.exclude else df
    return rows.select(*[F.col(c.name) for c in spec.columns])


def chunk_bounds(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(``chunk``, ``upper_bound``) of the table's chunks of ``chunk_size`` rows, by its chunk column, else the first of its key."""
    from quaymark.operators.recon import boundaries

    return boundaries(extract(df, spec), spec.chunk_column or spec.primary_key[0], spec.chunk_size or TableSpec.chunk_size)
