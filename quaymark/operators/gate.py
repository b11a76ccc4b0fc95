"""Phases of a migration and the gate that says whether, and if not exactly why not, it may cut over."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaymark.operators.dead_letters import OPEN

# Which phase may follow which, and the codes of what stands in the way.
TRANSITIONS = {
    "planning": ["extracting", "failed"],
    "extracting": ["loading", "streaming", "failed"],
    "loading": ["extracting", "streaming", "failed"],
    "streaming": ["verifying", "loading", "failed"],
    "verifying": ["ready_for_cutover", "streaming", "failed"],
    "ready_for_cutover": ["cutting_over", "streaming", "verifying", "failed"],
    "cutting_over": ["cutover", "rolled_back", "failed"],
    "cutover": ["completed", "rolled_back"],
    "completed": [],
    "rolled_back": ["streaming", "failed"],
    "failed": ["planning"],
}
EVALUATED = ["streaming", "verifying", "ready_for_cutover"]
MIN_REASON_BYTES = 20


@dataclass(frozen=True)
class Thresholds:
    """Seconds and counts that cutover requires; 0 seconds switch a condition off."""

    max_lag: float = 10
    lag_stable_for: float = 900
    max_open_letters: int = 0
    max_findings: int = 0
    max_recon_age: float = 1800
    all_parts: bool = True
    reverse: bool = True


def may_follow(before: Column, after: Column) -> Column:
    """Whether a phase may follow another; staying is always allowed, an unknown phase never."""
    table = F.map_from_arrays(F.array(*map(F.lit, TRANSITIONS)), F.array(*[F.array(*map(F.lit, v)).cast("array<string>") for v in TRANSITIONS.values()]))
    known = F.map_contains_key(table, before) & F.map_contains_key(table, after)
    return F.coalesce(known & ((before == after) | F.array_contains(F.element_at(table, before), after)), F.lit(False))


def transitions(spark) -> DataFrame:
    """(``phase``, ``next_phase``, ``allowed``) of all pairs of phases."""
    pairs = spark.createDataFrame([(a, b) for a in TRANSITIONS for b in TRANSITIONS], "phase string, next_phase string")
    return pairs.withColumn("allowed", may_follow(F.col("phase"), F.col("next_phase")))


def blockers(observed: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """``observed`` with ``blockers``, all codes in order, and ``ready``.

    observed: ``phase``, ``lag``, ``lag_under_for``, ``open_letters``, ``findings``, ``recon_complete``,
    ``recon_age`` (seconds, null: never), ``parts_total``, ``parts_loaded``, ``reverse_armed``.
    """
    c = F.col
    high = (c("lag") > t.max_lag) if t.max_lag > 0 else F.lit(False)
    unstable = (~high & (c("lag_under_for") < t.lag_stable_for)) if t.lag_stable_for > 0 else F.lit(False)
    stale = (c("recon_complete") & (c("recon_age").isNull() | (c("recon_age") > t.max_recon_age))) if t.max_recon_age > 0 else F.lit(False)
    rules = {
        "wrong_phase": ~F.coalesce(c("phase").isin(EVALUATED), F.lit(False)),
        "lag_above_threshold": high,
        "lag_not_stable_long_enough": unstable,
        "open_dead_letters": c("open_letters") > t.max_open_letters,
        "reconciliation_findings": c("findings") > t.max_findings,
        "reconciliation_incomplete": ~F.coalesce(c("recon_complete"), F.lit(False)),
        "reconciliation_stale": stale,
        "parts_not_loaded": (c("parts_loaded") < c("parts_total")) if t.all_parts else F.lit(False),
        "reverse_replication_not_armed": ~F.coalesce(c("reverse_armed"), F.lit(False)) if t.reverse else F.lit(False),
    }
    found = F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(code)) for code, rule in rules.items()])))
    return observed.withColumn("blockers", found).withColumn("ready", F.size("blockers") == 0)


def override_problem(by: Column, reason: Column, acknowledged: Column, active: Column) -> Column:
    """Why an override isn't valid, or null: it needs an author, a reason of 20 bytes, and every active blocker named."""
    missing = F.array_sort(F.array_except(active, acknowledged))
    return (
        F.when(F.coalesce(by, F.lit("")) == "", "no author")
        .when(F.octet_length(F.coalesce(reason, F.lit(""))) < MIN_REASON_BYTES, "reason too short")
        .when(F.size(missing) > 0, F.concat(F.lit("not acknowledged: "), F.concat_ws(" ", missing)))
    )


def lag_stability(samples: DataFrame, max_lag: float, series: str, at: str = "ts", lag: str = "lag") -> DataFrame:
    """(``series``, ``current_lag``, ``under_seconds``): how long each series has been under the threshold up to its last sample.

    The newest sample over the threshold decides, so two maxima per series do; no series is gathered.
    """
    over = F.max(F.when(F.col(lag) > max_lag, F.col(at)))
    ends = samples.groupBy(series).agg(F.max(at).alias("__last"), F.max_by(lag, at).alias("current_lag"), over.alias("__over"))
    after = samples.filter(F.col(lag) <= max_lag).join(ends, series).filter(F.col("__over").isNull() | (F.col(at) > F.col("__over")))
    since = after.groupBy(series).agg(F.min(at).alias("__since"))
    held = F.when(F.col("__since").isNotNull(), (F.unix_micros("__last") - F.unix_micros("__since")) / 1e6).otherwise(0.0)
    return ends.join(since, series, "left").select(series, "current_lag", held.alias("under_seconds"))


def lag_periods(samples: DataFrame, max_lag: float, series: str, at: str = "ts", lag: str = "lag", tie: str = "event_id") -> DataFrame:
    """(``series``, ``period``, ``samples``, ``seconds``) of each stretch under the threshold, gaps and islands."""
    w = W.partitionBy(series).orderBy(at, tie)
    broken = F.sum(F.when(F.col(lag) > max_lag, 1).otherwise(0)).over(w)
    quiet = samples.withColumn("period", broken).filter(F.col(lag) <= max_lag)
    return quiet.groupBy(series, "period").agg(F.count(F.lit(1)).alias("samples"), ((F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 1e6).alias("seconds"))


def histogram(df: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """One row: cumulative counts ``le_0`` … of values up to each bound, ``total`` and ``total_value``."""
    return df.agg(*[F.coalesce(F.sum(F.when(F.col(value) <= b, 1)), F.lit(0)).alias(f"le_{i}") for i, b in enumerate(bounds)], F.count(value).alias("total"), F.sum(value).alias("total_value"))


def status(state: DataFrame, part_state: DataFrame, letters: DataFrame, runs: DataFrame, lag: DataFrame, now: Column) -> DataFrame:
    """A row per migration of ``state`` with all that the gate looks at, as ``blockers`` wants it.

    state: ``migration_state``; part_state: ``part_state`` (loaded parts); letters: ``dead_letter``; runs:
    ``recon_run``; lag: ``migration_id``, ``lag``, ``lag_under_for``. Of runs the last of each table counts; a
    migration without any was never verified, one without lag samples has infinite lag.
    """
    by = "migration_id"
    loaded = part_state.filter("state = 'loaded'").groupBy(by).agg(F.count(F.lit(1)).cast("int").alias("__loaded"))
    still = letters.filter(F.col("status").isin(OPEN)).groupBy(by).agg(F.count(F.lit(1)).alias("open_letters"))
    last = runs.groupBy(by, "source_table").agg(F.max_by(F.struct("complete", "findings", "ran_at"), F.struct("ran_at", "run_id")).alias("r"))
    checked = last.groupBy(by).agg(F.sum("r.findings").alias("findings"), F.min("r.complete").alias("recon_complete"), F.min("r.ran_at").alias("__ran"))
    all_ = state.join(loaded, by, "left").join(still, by, "left").join(checked, by, "left").join(lag, by, "left")
    return all_.select(
        by, "phase", F.coalesce("lag", F.lit(float("inf"))).alias("lag"), F.coalesce("lag_under_for", F.lit(0.0)).alias("lag_under_for"), F.coalesce("open_letters", F.lit(0)).alias("open_letters"),
        F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("recon_complete", F.lit(False)).alias("recon_complete"), ((F.unix_micros(now) - F.unix_micros("__ran")) / 1e6).alias("recon_age"),
        "parts_total", F.coalesce("__loaded", F.lit(0)).alias("parts_loaded"), "reverse_armed",
    )


def readiness(observed: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:  # noqa: B008
    """(``migration_id``, ``ready``, ``code``: 200 or 409, ``blockers``) of each migration."""
    return blockers(observed, t).select("migration_id", "ready", F.when(F.col("ready"), 200).otherwise(409).alias("code"), "blockers")


def metrics(df: DataFrame, labels: list[str], value: str, bounds: list[float]) -> DataFrame:
    """(labels, ``samples``, ``total``, ``last``, ``buckets``) of each series: a counter, its sum, a gauge, a cumulative histogram.

    ``df`` has ``at``; of samples at the same time the larger value is the last. Sums are formed before the shuffle.
    """
    made = df.groupBy(*labels).agg(
        F.count(value).alias("samples"), F.sum(value).alias("total"), F.max_by(value, F.struct("at", value)).alias("last"),
        F.array(*[F.coalesce(F.sum(F.when(F.col(value) <= b, 1)), F.lit(0)) for b in bounds], F.count(value)).alias("buckets"),
    )
    return made


#: Upper bounds of the default histogram, in seconds.
BUCKETS = [0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60]
