"""The snapshot window: rows of a chunk read between two watermarks give way to changes seen between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def problems(chunk: DataFrame, keys: list[str], chunk_id: str = "chunk_id") -> DataFrame:
    """(``chunk_id``, ``problem``) of chunks that can't be used: without an id, or with a key twice."""
    sizes = chunk.groupBy(chunk_id, *keys).agg(F.count(F.lit(1)).alias("n")).groupBy(chunk_id).agg(F.max("n").alias("most"))
    problem = F.when(F.coalesce(F.col(chunk_id).cast("string"), F.lit("")) == "", "chunk id is required").when(F.col("most") > 1, "chunk has a key twice; chunk boundaries overlap")
    return sizes.select(chunk_id, problem.alias("problem")).filter("problem IS NOT NULL")


def busy(marks: DataFrame, by: str) -> DataFrame:
    """(``by``, ``chunk_id``, ``problem``) of windows that open while an earlier one of the same ``by`` (a table) is open.

    marks: ``by``, ``chunk_id``, ``low``, ``high``. A table has a row per chunk, not per row, in the order of their marks.
    """
    before = W.partitionBy(by).orderBy("low", "chunk_id").rowsBetween(W.unboundedPreceding, -1)
    found = marks.withColumn("__until", F.max("high").over(before)).filter(F.col("low") < F.col("__until"))
    return found.select(by, "chunk_id", F.lit("another chunk of the table is open").alias("problem"))


def survivors(chunk: DataFrame, events: DataFrame, marks: DataFrame, keys: list[str], position: str = "lsn") -> DataFrame:
    """Rows of chunks that no event between their chunk's low and high watermark is newer than.

    chunk: ``chunk_id``, ``ord``, keys, payload; events: keys and ``position``; marks: ``chunk_id``, ``low``,
    ``high``, a row per chunk. Chunks without both watermarks give nothing yet. A hot key costs a row per chunk.
    """
    marks = marks.filter("low IS NOT NULL AND high IS NOT NULL").select("chunk_id", "low", "high")
    c = chunk.join(marks.select("chunk_id"), "chunk_id", "left_semi").alias("c")
    widest = marks.agg(F.max(F.col("high") - F.col("low"))).first()[0]
    if widest is None:
        return c.select("c.*")
    # The log is cut to what lies in some window, found by stretches of positions as long as the widest window, of
    # which a window meets two at most; of that a row per key and chunk is left before anything is shuffled by key.
    stretch = lambda at: F.floor(at / max(int(widest), 1))
    b = marks.withColumn("stretch", F.explode(F.sequence(stretch(F.col("low")), stretch(F.col("high"))))).alias("b")
    e = events.select(F.struct(*keys).alias("key"), F.col(position).alias("at")).withColumn("stretch", stretch(F.col("at"))).alias("e")
    inside = (F.col("e.at") > F.col("b.low")) & (F.col("e.at") < F.col("b.high"))
    seen = e.join(b, [F.col("e.stretch") == F.col("b.stretch"), inside]).groupBy("b.chunk_id", "e.key").agg(F.count(F.lit(1)).alias("n")).alias("s")
    same = [F.col(f"c.{k}").eqNullSafe(F.col("s.key")[k]) for k in keys]
    return c.join(seen, [F.col("c.chunk_id") == F.col("s.chunk_id"), *same], "left_anti").select("c.*")


def stats(chunk: DataFrame, emitted: DataFrame) -> DataFrame:
    """(``chunk_id``, ``rows_buffered``, ``rows_emitted``, ``rows_evicted``) per chunk."""
    held = chunk.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows_buffered"))
    out = emitted.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows_emitted"))
    n = F.coalesce("rows_emitted", F.lit(0))
    return held.join(out, "chunk_id", "left").select("chunk_id", "rows_buffered", n.alias("rows_emitted"), (F.col("rows_buffered") - n).alias("rows_evicted"))
