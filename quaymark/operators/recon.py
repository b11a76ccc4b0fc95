"""Verification: range digests that narrow to the rows that differ, and what is wrong with each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaymark.functions.canonical import canonical_key, key_hash, key_partition
from quaymark.functions.digest import range_digest, row_digest
from quaymark.plans.spec import Plan, TableSpec

# Budgets of a run, kinds of findings.
LEAF_ROWS, MAX_DEPTH, MAX_FINDINGS = 5000, 48, 1000
MISSING_IN_TARGET, MISSING_IN_SOURCE, VALUE_MISMATCH, UNRESOLVED = "missing_in_target", "missing_in_source", "value_mismatch", "range_unresolved"


def range_filter(column: Column, low: Any = None, high: Any = None) -> Column:
    """Half-open (low, high]; None is unbounded."""
    out = F.lit(True)
    if low is not None:
        out = out & (column > F.lit(low))
    if high is not None:
        out = out & (column <= F.lit(high))
    return out


def live(df: DataFrame, deleted: str = "_mig_deleted") -> DataFrame:
    """Without tombstones, on a side that has them."""
    return df.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted in df.columns else df


def bucket_digests(df: DataFrame, bucket: Column, digest: Column) -> DataFrame:
    """(``bucket``, ``row_count``, ``sum_lo``, ``sum_hi``) in one pass; sums are formed before the shuffle."""
    return df.select(bucket.alias("bucket"), digest.alias("__digest")).groupBy("bucket").agg(*range_digest(F.col("__digest")))


def differing_buckets(source: DataFrame, target: DataFrame) -> DataFrame:
    """Buckets of which the digests of both sides differ or one side has none."""
    s, t = source.alias("s"), target.alias("t")
    same = F.lit(True)
    for c in ("row_count", "sum_lo", "sum_hi"):
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    out = s.join(t, F.col("s.bucket").eqNullSafe(F.col("t.bucket")), "full_outer").filter(~same)
    return out.select(F.coalesce("s.bucket", "t.bucket").alias("bucket"), F.coalesce("s.row_count", F.lit(0)).alias("source_rows"), F.coalesce("t.row_count", F.lit(0)).alias("target_rows"))


def compare_rows(source: DataFrame, target: DataFrame, key: str, digest: str = "digest") -> DataFrame:
    """(``key``, ``kind``) of rows (key, digest) that one side lacks or that differ."""
    s, t = (df.select(F.col(key).alias(f"{n}k"), F.col(digest).alias(f"{n}d"), F.lit(True).alias(f"{n}x")) for df, n in ((source, "s"), (target, "t")))
    joined = s.join(t, F.col("sk").eqNullSafe(F.col("tk")), "full_outer")  # a null key is a key
    kind = F.when(F.col("tx").isNull(), MISSING_IN_TARGET).when(F.col("sx").isNull(), MISSING_IN_SOURCE).when(~F.col("sd").eqNullSafe(F.col("td")), VALUE_MISMATCH)
    return joined.select(F.coalesce("sk", "tk").alias(key), kind.alias("kind")).filter("kind IS NOT NULL")


def reconcile(source: DataFrame, target: DataFrame, key: str, digest: Callable[[DataFrame], Column], bucket: Callable[[Column], Column]) -> DataFrame:
    """(``key``, ``kind``) of all differences, by one digest pass over each side and rows of differing buckets only.

    The list of differing buckets is joined, and broadcast if Spark finds it small: no rows of clean buckets
    are shuffled for the comparison of rows.
    """
    source, target = live(source), live(target)
    s = source.select(F.col(key), bucket(F.col(key)).alias("bucket"), digest(source).alias("digest"))
    t = target.select(F.col(key), bucket(F.col(key)).alias("bucket"), digest(target).alias("digest"))
    wrong = differing_buckets(bucket_digests(s, F.col("bucket"), F.col("digest")), bucket_digests(t, F.col("bucket"), F.col("digest"))).select("bucket")
    return compare_rows(s.join(wrong, "bucket", "left_semi"), t.join(wrong, "bucket", "left_semi"), key)


def summary(findings: DataFrame) -> DataFrame:
    """(``kind``, ``findings``, ``repairable``): how many of each kind; what the source has can be sent again.

    Findings that are recorded (``found_at``) also tell ``first_seen_at``.
    """
    seen = [F.min("found_at").alias("first_seen_at")] if "found_at" in findings.columns else []
    return findings.groupBy("kind").agg(F.count(F.lit(1)).alias("findings"), *seen).withColumn("repairable", F.col("kind").isin(MISSING_IN_TARGET, VALUE_MISMATCH))


def in_order(findings: DataFrame, budget: int | None = MAX_FINDINGS) -> DataFrame:
    """Findings (``key_hash``, ``kind``, ``row_key``) by key hash, what the source has first; no more than the budget."""
    ordered = findings.orderBy("key_hash", F.col("kind") == MISSING_IN_SOURCE, "row_key")
    return ordered if budget is None else ordered.limit(budget)


def verify_table(source: DataFrame, target: DataFrame, spec: TableSpec, buckets: int = 4096) -> DataFrame:
    """(``row_key``, ``key_hash``, ``kind``) of all differences of a planned table, tombstones left out on both sides.

    Keys are compared in their canonical form, rows by the digest of the columns that both sides can be compared
    on. A source whose columns are protected on the target has to come protected.
    """

    def side(df: DataFrame, as_target: bool) -> DataFrame:
        df = live(df)
        names = {c.name: c.target if as_target else c.name for c in spec.columns}
        key = canonical_key({k: (df[names[k]], df.schema[names[k]].dataType) for k in spec.primary_key})
        return df.select(key.alias("row_key"), row_digest(df, spec.comparable(), as_target).alias("digest"))

    found = reconcile(side(source, False), side(target, True), "row_key", lambda df: df["digest"], lambda key: key_partition(key, buckets))
    return found.select("row_key", key_hash(F.col("row_key")).alias("key_hash"), "kind")


def verify_plan(plan: Plan, sides: dict[str, tuple[DataFrame, DataFrame]], run_id: str, migration_id: str, at: Column, budget: int = MAX_FINDINGS, buckets: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(runs, findings), as the control tables ``recon_run`` and ``recon_finding`` have them, of all tables of a plan.

    sides: source and target of each planned table; one that is missing is an error. Of each table ``budget``
    findings are recorded, in order; a run that has more isn't complete.
    """
    if missing := sorted(set(plan.names()) - set(sides)):
        raise ValueError(f"no sides of tables {missing}")
    runs, findings = [], []
    for spec in plan.tables:
        found = in_order(verify_table(*sides[spec.source], spec, buckets), budget + 1).checkpoint()  # once, for both results
        kept = in_order(found, budget)
        n = found.agg(F.count(F.lit(1)).cast("int").alias("n"))
        runs.append(
            n.select(
                F.lit(run_id).alias("run_id"), F.lit(migration_id).alias("migration_id"), F.lit(spec.source).alias("source_table"), (F.col("n") <= budget).alias("complete"),
                F.least("n", F.lit(budget)).alias("findings"), F.lit(2).alias("digests"), at.alias("ran_at"),
            )
        )
        none = F.lit(None).cast("string")
        findings.append(kept.select(F.lit(run_id).alias("run_id"), "kind", "key_hash", "row_key", none.alias("range_low"), none.alias("range_high"), at.alias("found_at")))
    return reduce(DataFrame.unionByName, runs), reduce(DataFrame.unionByName, findings)


def boundaries(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Every ``rows``-th key in order: upper bounds of chunks. Keys are unique.

    Ranges are dealt once and staged with their numbers and each row's place in its range, so that counts and places
    are of the same ranges, whatever is evaluated again.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    placed = df.select(F.col(key)).repartitionByRange(parts, key).sortWithinPartitions(key).withColumn("__at", F.monotonically_increasing_id())
    numbered = placed.withColumns({"__p": F.shiftright("__at", 33), "__n": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1}).drop("__at").checkpoint()
    sizes = numbered.groupBy("__p").agg(F.max("__n").alias("__size"))
    before = F.coalesce(F.sum("__size").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rank = F.col("__n") + F.col("__before")
    ranked = numbered.join(F.broadcast(sizes.select("__p", before.alias("__before"))), "__p")  # a row per range
    return ranked.withColumn("__rank", rank).filter(F.col("__rank") % rows == 0).select((F.col("__rank") / rows).cast("long").alias("chunk"), F.col(key).alias("upper_bound"))


def bisect_int(low: int | None, high: int | None) -> int | None:
    """A key strictly inside (low, high), or None. An open side steps away by 2**20; both open: 0."""
    if low is None and high is None:
        return 0
    if low is None or high is None:
        at = high - (1 << 20) if low is None else low + (1 << 20)
        return max(-(2**63), min(2**63 - 1, at))
    mid = (low + high) >> 1
    return mid if low < mid < high else None


def bisect_text(low: bytes | None, high: bytes | None) -> bytes | None:
    """The midpoint of two byte strings read as fractions; bytes, as it need not be valid text."""
    if low is None and high is None:
        return None
    if high is None:
        return low + b"\xff"
    low = low or b""
    if low >= high:
        return None
    n = max(len(low), len(high)) + 8
    mid = (int.from_bytes(low.ljust(n, b"\0"), "big") + int.from_bytes(high.ljust(n, b"\0"), "big")) >> 1
    out = mid.to_bytes(n, "big").rstrip(b"\0")
    return out if low < out < high else None


def bisect_time(low: datetime | None, high: datetime | None) -> datetime | None:
    if low is None and high is None:
        return None
    if low is None or high is None:
        return high - timedelta(hours=24) if low is None else low + timedelta(hours=24)
    mid = low + (high - low) / 2
    return mid if low < mid < high else None


def bisector(dtype: str) -> Callable:
    """By the Spark type of the key."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return bisect_int
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return bisect_time
    if dtype in ("string", "binary"):
        return bisect_text
    raise ValueError(f"no bisector for keys of type {dtype}")


@dataclass
class Run:
    """What a descent asked and found: digest queries, leaf reads, ranges it couldn't split."""

    digests: int = 0
    reads: int = 0
    findings: list[tuple] = field(default_factory=list)
    unresolved: list[tuple] = field(default_factory=list)
    complete: bool = True


def descend(digest: Callable[[Any, Any], tuple[tuple, tuple]], read: Callable[[Any, Any], list[tuple]], split: Callable, low: Any, high: Any, leaf: int = LEAF_ROWS, depth: int = MAX_DEPTH, budget: int = MAX_FINDINGS) -> Run:
    """Where two sides differ, by halving ranges whose digests differ until they are small enough to read.

    digest: both sides' (rows, lo, hi) of a range; read: (key, kind) of its differing rows. For sources that
    answer a range query faster than a scan; ``reconcile`` is the way over files.
    """
    run = Run()
    todo = [(low, high, 0)]
    while todo:
        a, b, d = todo.pop()
        if len(run.findings) >= budget:
            run.complete = False
            break
        s, t = digest(a, b)
        run.digests += 1
        if s == t:
            continue
        if max(s[0], t[0]) <= leaf:
            run.reads += 1
            run.findings += read(a, b)[: budget - len(run.findings)]
            continue
        mid = split(a, b) if d < depth else None
        if mid is None:
            run.unresolved.append((a, b, s[0], t[0]))  # never clean
            run.complete = False
        else:
            todo += [(mid, b, d + 1), (a, mid, d + 1)]
    return run
