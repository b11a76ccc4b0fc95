"""Digests that are equal on both sides exactly if rows are, whatever order they come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.plans.spec import ColumnSpec, Logical

#: Eight characters that stand for a null in a row digest, and what goes between columns.
NULL_TEXT = "\\x00NULL"
SEPARATOR = "\x1f"


def digest_text(c: Column, spec: ColumnSpec) -> Column:
    """The text of a value that both stores agree on; nulls as ``NULL_TEXT``, but of a boolean as false."""
    kind = spec.type
    if kind == Logical.BOOL:
        return F.when(c, "1").otherwise("0")
    if kind == Logical.DECIMAL:
        text = F.round(c.cast("decimal(38,18)"), spec.scale).cast(f"decimal(38,{spec.scale})").cast("string")
    elif kind == Logical.FLOAT:
        text = c.try_cast("decimal(38,12)").cast("string")
    elif kind == Logical.TIMESTAMP:
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif kind == Logical.DATE:
        text = F.date_format(c, "yyyy-MM-dd")
    elif kind == Logical.BYTES:
        text = F.lower(F.hex(c))
    else:
        text = c.cast("string")
    if spec.trim_trailing_space:
        text = F.rtrim(text)
    return F.coalesce(text, F.lit(NULL_TEXT))


def row_digest(df: DataFrame, columns: list[ColumnSpec], target: bool = False) -> Column:
    """md5 over the columns in declared order; ``target``: ``df`` has the target's column names."""
    return F.md5(F.concat_ws(SEPARATOR, *[digest_text(df[c.target if target else c.name], c) for c in columns]))


def _sixty_bits(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def range_digest(digest: Column) -> list[Column]:
    """Aggregates ``row_count``, ``sum_lo``, ``sum_hi``: how many rows, and two sums of 60 bits of their digests."""
    zero = F.lit(0).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(_sixty_bits(digest, 1)), zero).cast("decimal(38,0)").alias("sum_lo"),
        F.coalesce(F.sum(_sixty_bits(digest, 17)), zero).cast("decimal(38,0)").alias("sum_hi"),
    ]
