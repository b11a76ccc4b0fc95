import random
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaymark.operators import apply, cdc, dead_letters, gate, recon, window
from quaymark.plans.spec import META_DELETED, META_LSN, META_UPDATED

EVENT = "k string, lsn long, offset long, arrival long, op string, v string"


def test_coalesce_keeps_the_newest(spark):
    rows = [("A-1", 10, 1, 0, "u", "a"), ("A-2", 11, 2, 1, "u", "b"), ("A-1", 12, 3, 2, "u", "c"), ("A-1", 15, 4, 3, "u", "d")]
    found = apply.coalesce_newest(spark.createDataFrame(rows, EVENT), ["k"], ["lsn", "offset", "arrival"]).collect()
    assert {r["k"]: r["lsn"] for r in found} == {"A-1": 15, "A-2": 11}
    tie = [("A", 50, 9, 0, "u", "late"), ("A", 50, 7, 1, "u", "early"), ("B", 99, 1, 2, "u", "x"), ("B", 12, 2, 3, "u", "y")]
    found = apply.coalesce_newest(spark.createDataFrame(tie, EVENT), ["k"], ["lsn", "offset", "arrival"]).collect()
    assert {r["k"]: r["v"] for r in found} == {"A": "late", "B": "x"}


TARGET = f"k string, v string, {META_LSN} long, {META_DELETED} boolean, {META_UPDATED} timestamp"


def run(spark, steps, **how):
    target = spark.createDataFrame([], TARGET)
    for op, lsn, v in steps:
        target = apply.fence_merge(target, spark.createDataFrame([("A", op, lsn, v)], "k string, op string, lsn long, v string"), ["k"], ["v"], F.timestamp_seconds(F.lit(0)), **how)
    return target.first()


def test_fence(spark):
    stale = run(spark, [("u", 100, "500"), ("u", 50, "1"), ("u", 200, "750")])
    assert (stale["v"], stale[META_LSN]) == ("750", 200)
    assert run(spark, [("u", 100, "500"), ("u", 50, "1")])["v"] == "500"
    dead = run(spark, [("u", 100, "a"), ("d", 200, None), ("u", 150, "b")])
    assert dead[META_DELETED] and dead[META_LSN] == 200 and dead["v"] == "a"
    back = run(spark, [("d", 100, None), ("u", 200, "b")])
    assert not back[META_DELETED] and back["v"] == "b"
    assert run(spark, [("u", 100, "a"), ("u", 100, "b")])["v"] == "b"
    assert run(spark, [("u", 100, "a"), ("u", 200, None)])["v"] is None
    assert run(spark, [("u", 100, "a"), ("u", 200, None)], keep_absent=True)["v"] == "a"


def test_staging_merge(spark):
    target = spark.createDataFrame([("A-1", "999", 1000, False, None), ("A-3", "x", 100, True, None)], TARGET)
    part = spark.createDataFrame([("A-1", "1"), ("A-2", "42"), ("A-2", "42"), ("A-3", "y")], "k string, v string")
    found = {r["k"]: r for r in apply.merge_part(target, part, ["k"], ["v"], 500, F.timestamp_seconds(F.lit(0))).collect()}
    assert (found["A-1"]["v"], found["A-1"][META_LSN]) == ("999", 1000)
    assert (found["A-2"]["v"], found["A-2"][META_LSN]) == ("42", 500)
    assert found["A-3"][META_DELETED] and found["A-3"]["v"] == "y"  # a load doesn't bring a deleted row back


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 30), st.sampled_from("ud")), min_size=1, max_size=12, unique_by=lambda e: e[1]), st.randoms())
def test_visible_state_does_not_depend_on_arrival(spark, events, rng):
    def state(order):
        target = spark.createDataFrame([], TARGET)
        for at in range(0, len(order), 4):
            batch = spark.createDataFrame([(k, op, lsn, str(lsn)) for k, lsn, op in order[at : at + 4]], "k string, op string, lsn long, v string")
            target = apply.fence_merge(target, apply.coalesce_newest(batch, ["k"], ["lsn"]), ["k"], ["v"], F.timestamp_seconds(F.lit(0)))
        return sorted((r["k"], r["v"], r[META_LSN]) for r in apply.purge_tombstones(target).collect())

    mixed = list(events)
    rng.shuffle(mixed)
    whole = spark.createDataFrame([(k, lsn, op, str(lsn)) for k, lsn, op in events], "k string, lsn long, op string, v string")
    settled = apply.purge_tombstones(apply.settled_state(whole, ["k"], ["lsn"])).collect()
    assert state(events) == state(mixed)
    assert state(events) == sorted((r["k"], r["v"], r[META_LSN]) for r in settled) or "v" not in settled[0].asDict()


def test_offsets_only_advance(spark):
    s = "topic string, partition int, last_offset long, last_lsn long"
    stored = spark.createDataFrame([("t", 0, 100, 7)], s)
    for new, want in ((50, 100), (150, 150)):
        assert apply.advance_offsets(stored, spark.createDataFrame([("t", 0, new, 8)], s), ["topic", "partition"]).first()["last_offset"] == want
    events = spark.createDataFrame([("t", 0, 5, 1), ("t", 0, 9, 2), (None, 0, 99, 3), ("", 1, 99, 3)], "topic string, partition int, offset long, lsn long")
    assert [r[:] for r in apply.high_water_marks(events).collect()] == [("t", 0, 9, 2)]


def test_isolation_finds_the_bad_ones():
    applied = []

    def sink(rows):
        if 13 in rows or 77 in rows:
            raise ValueError("poison")
        applied.extend(rows)

    good, bad = apply.isolate(list(range(100)), sink)
    assert sorted(good) == sorted(applied) == [i for i in range(100) if i not in (13, 77)] and sorted(r for r, _ in bad) == [13, 77]


# Verification over a table in memory, as the reference's own bounds are stated.


def memory(n, changed=(), missing=(), extra=()):
    source = dict.fromkeys(range(n), 0)
    target = {k: (1 if k in changed else 0) for k in source if k not in missing} | dict.fromkeys(extra, 0)

    def within(side, low, high):
        return sorted((k, v) for k, v in side.items() if low < k <= high)

    def digest(low, high):
        return tuple((len(r), hash(tuple(r)), 0) for r in (within(source, low, high), within(target, low, high)))

    def read(low, high):
        s, t = dict(within(source, low, high)), dict(within(target, low, high))
        kinds = [(k, recon.MISSING_IN_TARGET if k not in t else recon.VALUE_MISMATCH) for k in s if s.get(k) != t.get(k)]
        return kinds + [(k, recon.MISSING_IN_SOURCE) for k in t if k not in s]

    return digest, read


def test_descent_costs():
    run = recon.descend(*memory(50_000), recon.bisect_int, -1, 1_000_000)
    assert run.digests == 1 and run.reads == 0 and run.complete
    run = recon.descend(*memory(100_000, changed={77_777}), recon.bisect_int, -1, 1_000_000, leaf=1000)
    assert run.findings == [(77_777, recon.VALUE_MISMATCH)] and run.digests <= 80 and run.reads <= 4
    run = recon.descend(*memory(50_000, changed={25_000}, missing={100, 49_999}, extra={888_888}), recon.bisect_int, -1, 1_000_000, leaf=1000)
    assert sorted(run.findings) == [(100, recon.MISSING_IN_TARGET), (25_000, recon.VALUE_MISMATCH), (49_999, recon.MISSING_IN_TARGET), (888_888, recon.MISSING_IN_SOURCE)]


def test_descent_never_calls_unresolved_clean():
    digest, read = memory(100, changed={5})
    run = recon.descend(digest, read, lambda a, b: None, -1, 1000, leaf=10)
    assert run.unresolved and not run.complete and not run.findings
    run = recon.descend(*memory(20_000, changed=set(range(0, 20_000, 2))), recon.bisect_int, -1, 20_000, leaf=100, budget=50)
    assert len(run.findings) == 50 and not run.complete


def test_bisectors():
    assert recon.bisect_int(0, 10) == 5 and recon.bisect_int(4, 5) is None and recon.bisect_int(None, None) == 0
    assert recon.bisect_int(2**63 - 3, 2**63 - 1) == 2**63 - 2 and recon.bisect_int(2**63 - 1, None) == 2**63 - 1
    low, high = b"ACCT-2026-08-000000001", b"ACCT-2026-08-000000002"
    for _ in range(20):
        mid = recon.bisect_text(low, high)
        assert low < mid < high
        high = mid
    assert recon.bisect_text(b"b", b"a") is None and recon.bisect_text(b"a", None) == b"a\xff"
    t = datetime(2026, 1, 1, tzinfo=UTC)
    assert recon.bisect_time(t, t + timedelta(hours=2)) == t + timedelta(hours=1) and recon.bisect_time(None, t) == t - timedelta(hours=24)
    assert recon.bisector("bigint") is recon.bisect_int
    with pytest.raises(ValueError):
        recon.bisector("array<int>")


def test_reconcile_leaves_tombstones_out(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    target = spark.createDataFrame([(1, "a", False), (2, "b", None), (3, "c", True)], f"id long, v string, {META_DELETED} boolean")
    assert recon.reconcile(source, target, "id", lambda df: F.md5(df["v"]), lambda k: k % 2).count() == 0


def test_window(spark):
    chunk = spark.createDataFrame([("c1", i, f"k{i}", str(i)) for i in range(5)] + [("c2", 9, "k1", "x")], "chunk_id string, ord long, k string, v string")
    marks = spark.createDataFrame([("c1", 10, 20)], "chunk_id string, low long, high long")
    events = spark.createDataFrame([("k1", 15), ("k2", 10), ("k3", 20), ("k4", 5), ("zz", 15)], "k string, lsn long")
    left = window.survivors(chunk, events, marks, ["k"])
    assert sorted(r["k"] for r in left.collect()) == ["k0", "k2", "k3", "k4"]
    assert window.problems(chunk, ["k"]).count() == 0
    assert window.problems(chunk.union(chunk), ["k"]).count() == 2


# Envelopes

KEYS = {"app.accounts": ["id"]}


def decode(spark, value, key='{"id": "k"}'):
    df = spark.createDataFrame([("t", 0, 1, key, value)], "topic string, partition int, offset long, key string, value string")
    return cdc.decode(df, KEYS).first()


def envelope(op="u", source='"schema": "app", "table": "accounts", "lsn": 5', image='{"id": 7.0, "v": "x"}'):
    return f'{{"op": "{op}", "before": null, "after": {image}, "source": {{{source}}}}}'


def test_decode(spark):
    e = decode(spark, envelope())
    assert (e["table"], e["op"], e["lsn"], e["row_key"], e["error"]) == ("app.accounts", "u", 5, {"id": "7"}, None)
    assert decode(spark, f'{{"payload": {envelope()}}}')["lsn"] == 5
    gone = decode(spark, '{"op": "d", "before": {"id": 8}, "after": null, "source": {"schema": "app", "table": "accounts", "lsn": 6}}')
    assert gone["row_key"] == {"id": "8"} and gone["error"] is None
    assert decode(spark, envelope(image='{"v": "x"}'))["row_key"] == {"id": "k"}
    assert decode(spark, envelope(image='{"v": "x"}'), '{"payload": {"id": 9}}')["row_key"] == {"id": "9"}
    assert decode(spark, "")["skipped"] and decode(spark, None)["error"] is None
    for bad in ("{broken", envelope(op="z"), envelope(op="t")):
        assert decode(spark, bad)["error"].startswith("permanent")
    assert decode(spark, envelope(image='{"v": "x"}'), None)["error"] == "permanent: no row key can be derived"


def test_sequence_numbers(spark):
    lsn = lambda s: decode(spark, envelope(source=f'"schema": "app", "table": "accounts", {s}'))["lsn"]
    assert lsn('"lsn": "0/1A2B3C4D"') == 439041101
    assert lsn('"lsn": 9007199254740993') == 9007199254740993
    assert lsn('"file": "mysql-bin.000042", "pos": 4') > lsn('"file": "mysql-bin.000041", "pos": 999999')
    assert lsn('"ts_ms": 1700000000000') == 1700000000000
    assert lsn('"scn": "12"') == 12 and lsn('"connector": "x"') == 0


# Dead letters


def classify(spark, **given):
    row = {"marker": None, "state": None, "number": None, "message": None} | given
    df = spark.createDataFrame([tuple(row.values())], "marker string, state string, number int, message string")
    return df.select(dead_letters.classify(*[F.col(c) for c in row])).first()[0]


@pytest.mark.parametrize(
    "given,want",
    [
        ({"state": "40001"}, "transient"), ({"state": "23505"}, "permanent"), ({"state": "57014"}, "transient"), ({"number": 1213}, "transient"), ({"number": 1062}, "permanent"),
        ({"message": "Deadlock found, data truncated"}, "transient"), ({"message": "value too long"}, "permanent"), ({"message": "odd"}, "unknown"), ({}, "unknown"),
        ({"marker": "permanent", "state": "40001"}, "permanent"), ({"state": "99999", "message": "try again"}, "transient"),
    ],
)
def test_classify(spark, given, want):
    assert classify(spark, **given) == want


def test_letters(spark):
    df = spark.createDataFrame([(1, "permanent", 1), (2, "transient", 1), (3, "transient", 11), (4, "unknown", 0)], "id long, error_class string, attempts int")
    found = {r["id"]: r for r in dead_letters.evaluate(df).collect()}
    assert [found[i]["new_status"] for i in (1, 2, 3, 4)] == ["quarantined", "pending", "quarantined", "pending"]
    assert found[2]["delay_seconds"] == 90 and found[4]["delay_seconds"] == 30
    long = spark.createDataFrame([("a\n" * 2000,)], "m string").select(dead_letters.summarise(F.col("m"))).first()[0]
    assert long.endswith("… (truncated)") and "\n" not in long


def test_retry_loop():
    waits, calls = [], []

    def work():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    retry = dead_letters.Retry(0.1, 2, 30, 8, jitter=False)
    assert retry.run(work, lambda e: True, waits.append) == "done" and waits == [0.1, 0.2]
    with pytest.raises(ValueError):
        retry.run(lambda: (_ for _ in ()).throw(ValueError()), lambda e: False, waits.append)
    assert dead_letters.LETTER_RETRY.seconds(99) == 7200


# Gate


def observed(spark, **over):
    row = {"phase": "verifying", "lag": 1.0, "lag_under_for": 1000.0, "open_letters": 0, "findings": 0, "recon_complete": True, "recon_age": 60.0, "parts_total": 3, "parts_loaded": 3, "reverse_armed": True} | over
    df = spark.createDataFrame([tuple(row.values())], "phase string, lag double, lag_under_for double, open_letters int, findings int, recon_complete boolean, recon_age double, parts_total int, parts_loaded int, reverse_armed boolean")
    return gate.blockers(df).first()


def test_gate(spark):
    assert observed(spark)["ready"]
    worst = observed(spark, phase="planning", lag=11.0, open_letters=1, findings=1, recon_complete=False, parts_loaded=1, reverse_armed=False)
    assert worst["blockers"] == sorted(["wrong_phase", "lag_above_threshold", "open_dead_letters", "reconciliation_findings", "reconciliation_incomplete", "parts_not_loaded", "reverse_replication_not_armed"])
    assert observed(spark, lag=10.0)["ready"]  # at the threshold is under it
    assert observed(spark, lag_under_for=899.0)["blockers"] == ["lag_not_stable_long_enough"]
    assert observed(spark, recon_age=None)["blockers"] == ["reconciliation_stale"]


def test_boundaries_are_every_nth_key(spark):
    keys = list(range(1000))
    random.Random(1).shuffle(keys)
    found = recon.boundaries(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 64).orderBy("chunk").collect()
    assert [(r["chunk"], r["upper_bound"]) for r in found] == [(i + 1, 64 * (i + 1) - 1) for i in range(15)]
