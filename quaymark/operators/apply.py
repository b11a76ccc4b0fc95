"""Applying changes: newest version of each row, fence by sequence number, tombstones, offsets.

A row's write is accepted if nothing newer is stored. Applied in batches or all at once, in any order, the
visible state ends up the same; that is what lets a batch be repeated after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaymark.plans.spec import META_DELETED, META_LSN, META_UPDATED


def coalesce_newest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One event of each key: the largest by ``order``. A map-side maximum, so a hot key costs a row per task."""
    rest = [c for c in events.columns if c not in keys]
    newest = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__e"))
    return newest.select(*keys, *[F.col(f"__e.{c}").alias(c) for c in rest])


def high_water_marks(events: DataFrame) -> DataFrame:
    """(``topic``, ``partition``, ``last_offset``, ``last_lsn``) of a batch; events without a topic don't count."""
    placed = events.filter(F.coalesce("topic", F.lit("")) != "")
    return placed.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"), F.max_by("lsn", F.struct("offset", "lsn")).alias("last_lsn"))


def advance_offsets(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Offsets after a commit: of each place the furthest, which no replay takes back."""
    return coalesce_newest(stored.unionByName(new), keys, ["last_offset", "last_lsn"])


def fence_merge(target: DataFrame, changes: DataFrame, keys: list[str], payload: list[str], at: Column, clear_tombstone: bool = True, keep_absent: bool = False) -> DataFrame:
    """The target after ``changes`` (keys, ``op``, ``lsn``, payload; one row a key).

    A change wins if the stored sequence number isn't larger. An upsert replaces the payload (``keep_absent``:
    only where it has a value) and, with ``clear_tombstone``, brings a deleted row back; a delete leaves a
    tombstone and keeps the payload. Rows keep their shape: keys, payload and the three meta columns.
    """
    t, s = target.alias("t"), changes.alias("s")
    joined = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full_outer")
    new = F.col("s.op").isNotNull()
    won = new & (F.col(f"t.{META_LSN}").isNull() | (F.col(f"t.{META_LSN}") <= F.col("s.lsn")))
    upsert = won & (F.col("s.op") != "d")

    def value(c: str) -> Column:
        incoming = F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")) if keep_absent else F.col(f"s.{c}")
        return F.when(upsert, incoming).otherwise(F.col(f"t.{c}")).alias(c)

    stored = F.coalesce(F.col(f"t.{META_DELETED}"), F.lit(False))
    deleted = F.when(won & (F.col("s.op") == "d"), True).when(upsert, F.lit(False) if clear_tombstone else stored).otherwise(stored)
    return joined.select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys],
        *[value(c) for c in payload],
        F.when(won, F.col("s.lsn")).otherwise(F.col(f"t.{META_LSN}")).alias(META_LSN),
        deleted.alias(META_DELETED),
        F.when(won, at).otherwise(F.col(f"t.{META_UPDATED}")).alias(META_UPDATED),
    )


def settled_state(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The state that a whole log leaves, without applying it batch by batch: the newest event of each key.

    Deleted rows are tombstones (``_mig_deleted``); their payload depends on the path and is null.
    """
    rest = [c for c in log.columns if c not in (*keys, *order, "op", "lsn")]
    newest = coalesce_newest(log, keys, order)
    live = F.col("op") != "d"
    return newest.select(*keys, *[F.when(live, F.col(c)).alias(c) for c in rest], F.col("lsn").alias(META_LSN), (~live).alias(META_DELETED))


def fence_decisions(log: DataFrame, keys: list[str], batch: str, order: list[str]) -> DataFrame:
    """Each batch's write of each key with ``stored_lsn`` before it and whether it was ``accepted``.

    Batches are coalesced first, so a key has a row per batch, however hot it is.
    """
    writes = coalesce_newest(log, [*keys, batch], order)
    before = W.partitionBy(*keys).orderBy(batch).rowsBetween(W.unboundedPreceding, -1)
    stored = F.max("lsn").over(before)
    return writes.withColumn("stored_lsn", stored).withColumn("accepted", F.col("stored_lsn").isNull() | (F.col("stored_lsn") <= F.col("lsn")))


def dedupe_part(part: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key of an extract part: the smallest by its other columns, so that repeats agree."""
    rest = sorted(c for c in part.columns if c not in keys)
    first = part.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
    return first.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def merge_part(target: DataFrame, part: DataFrame, keys: list[str], payload: list[str], extract_lsn: int, at: Column) -> DataFrame:
    """A part's rows under the fence, all with the extract's sequence number; tombstones stay tombstones."""
    rows = dedupe_part(part.select(*keys, *payload), keys).withColumn("op", F.lit("r")).withColumn("lsn", F.lit(extract_lsn).cast("long"))
    return fence_merge(target, rows, keys, payload, at, clear_tombstone=False)


def purge_tombstones(target: DataFrame) -> DataFrame:
    return target.filter(~F.coalesce(F.col(META_DELETED), F.lit(False)))


def split_known(events: DataFrame, tables: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events of planned tables, all others)."""
    known = F.coalesce(F.col("table").isin(tables), F.lit(False))
    return events.filter(known), events.filter(~known)


def isolate(rows: list, apply) -> tuple[list, list]:
    """(applied, failed with errors) for a sink that only tells whether all rows went in: halves until single rows fail."""
    if not rows:
        return [], []
    try:
        apply(rows)
        return list(rows), []
    except Exception as error:  # noqa: BLE001  what a sink raises is its own
        if len(rows) == 1:
            return [], [(rows[0], error)]
        half = len(rows) // 2
        first, second = isolate(rows[:half], apply), isolate(rows[half:], apply)
        return first[0] + second[0], first[1] + second[1]
