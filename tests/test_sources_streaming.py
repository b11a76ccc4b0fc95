import json
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions import protect
from quaymark.operators import gate
from quaymark.plans.spec import META_DELETED, META_LSN, META_UPDATED, ColumnSpec, Logical, Plan, Protection, TableSpec
from quaymark.sources import control, parts, scans
from quaymark.sources.versioned import VersionedStore
from quaymark.streaming.applier import Applier
from quaymark.streaming.live_window import ENTRY, live_window

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DecimalType(18, 2))])


def extract(spark, folder, n=25, rows=10, compress=False):
    names = [None, "", "\\N", 'Doe, John "Jack"\nsecond line', " lead", "plain"]
    df = spark.createDataFrame([(i, names[i % 6], None if i % 5 == 0 else f"{i}.50") for i in range(n)], "id long, name string, b string").select("id", "name", F.col("b").cast("decimal(18,2)").alias("balance"))
    made = parts.write_parts(df, str(folder), "app.accounts", ["id", "name", "balance"], "id", rows_per_part=rows, compress=compress)
    return df, [p for p in made.collect()]


@pytest.mark.parametrize("compress", [False, True])
def test_parts_round_trip(spark, tmp_path, compress):
    df, made = extract(spark, tmp_path, compress=compress)
    assert sum(p["rows"] for p in made) == 25 and max(p["rows"] for p in made) <= 10
    m = parts.manifest(made, "app.accounts", "core.accounts", ["id", "name", "balance"], 1, 9)
    parts.write_manifest(m, str(tmp_path / "accounts.manifest.json"))
    back = parts.read_parts(spark, [str(tmp_path / p["file"]) for p in made], SCHEMA)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert parts.verify_parts(spark, made, str(tmp_path)).count() == 0
    read = parts.read_manifests(spark, str(tmp_path / "*.manifest.json")).first()
    assert read["total_rows"] == 25 and len(read["parts"]) == len(made)


def test_changed_parts_are_found(spark, tmp_path):
    _, made = extract(spark, tmp_path)
    first, second, third = (tmp_path / p["file"] for p in made[:3])
    raw = bytearray(first.read_bytes())
    raw[0] ^= 1
    first.write_bytes(raw)
    second.write_bytes(second.read_bytes()[:-1])
    third.unlink()
    found = {r["file"]: r["problem"] for r in parts.verify_parts(spark, made, str(tmp_path)).collect()}
    assert found[first.name] == "sha256 differs" and "bytes" in found[second.name] and found[third.name] == "missing"


def test_parts_are_loaded_and_marked_together(spark, tmp_path):
    spec = TableSpec("app.accounts", "core.accounts", ("id",), (ColumnSpec("id", Logical.INT), ColumnSpec("name"), ColumnSpec("balance", Logical.DECIMAL, "amount", scale=2)))
    df, made = extract(spark, tmp_path)
    m = parts.manifest(made, "app.accounts", "core.accounts", ["id", "name", "balance"], 50, 90)
    store = VersionedStore(spark, f"file://{tmp_path}/store", buckets=4)
    schema = Applier(spark, Plan("p", (spec,)), store).target_schema("app.accounts")
    newer = spark.createDataFrame([(3, "kept", None, 60, False, None), (4, None, None, 70, True, None), (5, "old", None, 10, False, None)], schema)
    store.commit({}, 7, {"core_accounts": (newer, ["id"])})
    at = F.lit("2024-01-01").cast("timestamp")
    assert parts.load(spark, store, m, str(tmp_path), spec, "m", at) == len(made)
    rows = {r["id"]: r for r in store.table("core_accounts", schema).collect()}
    assert len(rows) == 25 and store.current() == (2, 7)
    assert rows[3]["name"] == "kept" and rows[4][META_DELETED] and rows[5][META_LSN] == 50 and rows[6]["name"] is None and str(rows[6]["amount"]) == "6.50"
    assert parts.load(spark, store, m, str(tmp_path), spec, "m", at) == 0 and store.current() == (2, 7)
    assert store.table("part_state", control.SCHEMAS["part_state"]).filter("state = 'loaded' AND migration_id = 'm'").count() == len(made)
    (tmp_path / made[0]["file"]).write_bytes(b"changed")
    with pytest.raises(ValueError):
        parts.load(spark, store, m, str(tmp_path), spec, "another", at)
    with pytest.raises(ValueError):
        parts.load(spark, store, m | {"total_rows": 1}, str(tmp_path), spec, "another", at)


def test_parts_written_again_are_the_same(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    first, second = (sorted((p["file"], p["bytes"], p["sha256"]) for p in extract(spark, tmp_path / d, compress=True)[1]) for d in ("a", "b"))
    assert first == second and not list(tmp_path.rglob("*.tmp"))


def test_manifest_problems():
    part = {"index": 0, "file": "f", "bytes": 1, "rows": 5, "sha256": "x", "gzip": False, "first_key": "", "last_key": "", "state": "sealed"}
    good = {"version": 1, "source_table": "a", "target_table": "b", "columns": ["c"], "delimiter": ",", "extract_start_lsn": 1, "extract_end_lsn": 2, "parts": [part], "total_rows": 5, "complete": True}
    assert parts.manifest_problem(good) is None
    for change in ({"version": 2}, {"columns": []}, {"parts": [part, part]}, {"total_rows": 6}, {"extract_end_lsn": 0}, {"parts": [part | {"sha256": ""}]}, {"parts": [part | {"state": "writing"}]}):
        assert parts.manifest_problem(good | change)


def test_scan_pushes_its_filter_down(spark, tmp_path):
    spark.range(1000).withColumn("v", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    plan = scans.range_scan(spark.read.parquet(str(tmp_path / "t")), ["id"], "id", 10, 20)._jdf.queryExecution().toString()
    assert "GreaterThan(id,10)" in plan and "LessThanOrEqual(id,20)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_store_versions(spark, tmp_path):
    store = VersionedStore(spark, f"file://{tmp_path}/s")
    assert store.current() == (0, -1) and store.table("t", "id long").count() == 0
    store.commit({"t": spark.range(3)}, 0)
    assert store.current() == (1, 0) and store.table("t", "id long").count() == 3
    assert store.commit({"t": spark.range(9)}, 0) == 1 and store.table("t", "id long").count() == 3  # the batch is done
    store.commit({"t": store.table("t", "id long").union(spark.range(1))}, 1)
    store.drop_before(2)
    assert store.table("t", "id long").count() == 4 and not os.path.exists(tmp_path / "s/v=1")


def test_control_tables(spark):
    letters = spark.createDataFrame([], control.SCHEMAS["dead_letter"])
    assert control.violations("dead_letter", letters).count() == 0
    states = spark.createDataFrame([("m", "loading", 2, 3, False, None)], control.SCHEMAS["migration_state"])
    assert control.violations("migration_state", states).count() == 1
    assert control.load_state(states, "new").first()["phase"] == "planning" and control.load_state(states, "m").first()["phase"] == "loading"
    assert gate.transitions(spark).filter("phase = 'completed' AND allowed").count() == 1
    done = spark.createDataFrame([("m", "t", 0, "loaded", 5, "x", None)], control.SCHEMAS["part_state"])
    assert control.mark_loaded(done, done).count() == 1


def message(i, op, key, lsn, value, partition=0, schema="app"):
    image = {"id": key, "v": value}
    body = {"op": op, "before": image if op == "d" else None, "after": None if op == "d" else image, "source": {"schema": schema, "table": "accounts", "lsn": lsn}}
    return {"topic": "t", "partition": partition, "offset": i, "key": json.dumps({"id": key}), "value": json.dumps(body)}


def test_applier_end_to_end(spark, tmp_path):
    plan = Plan("p", (TableSpec("app.accounts", "core.accounts", ("id",), (ColumnSpec("id"), ColumnSpec("v", target_name="value"))),))
    store = VersionedStore(spark, f"file://{tmp_path}/store")
    applier = Applier(spark, plan, store)
    files = tmp_path / "in"
    files.mkdir()

    def feed(name, messages):
        (files / name).write_text("\n".join(map(json.dumps, messages)))
        applier.start(str(files), str(tmp_path / "checkpoint"), available_now=True).awaitTermination()

    feed("1.json", [message(0, "c", "A", 100, "a"), message(1, "u", "A", 200, "b"), message(2, "c", "B", 150, "x"), {"topic": "t", "partition": 0, "offset": 3, "key": None, "value": "{broken"}])
    feed("2.json", [message(4, "u", "A", 50, "stale"), message(5, "d", "B", 300, ""), message(6, "u", "B", 250, "late"), message(7, "c", "Z", 1, "z", schema="other")])
    rows = {r["id"]: r for r in store.table("core_accounts", applier.target_schema("app.accounts")).collect()}
    assert (rows["A"]["value"], rows["A"][META_LSN]) == ("b", 200) and rows["B"][META_DELETED]
    assert store.table("offsets", "topic string, partition int, last_offset long, last_lsn long").first()["last_offset"] == 7
    letters = {r["offset"]: r for r in applier.letters().collect()}
    assert sorted(letters) == [3, 7] and {r["status"] for r in letters.values()} == {"quarantined"} and {r["payload"] for r in letters.values()} == {None}
    assert applier.letters().filter("attempts <> 1 OR error_class <> 'permanent'").count() == 0
    before = store.current()
    applier.apply_batch(spark.createDataFrame([], "topic string, partition int, offset long, key string, value string"), before[1])
    assert store.current() == before


def test_a_batch_writes_the_rows_it_concerns(spark, tmp_path):
    """Rows written don't depend on the table's size; states are as a whole rewrite would leave them."""
    schema = f"id long, v long, {META_LSN} long, {META_DELETED} boolean, {META_UPDATED} timestamp"

    def states(df, lsn):
        return df.select("id", (F.col("id") * lsn).alias("v"), F.lit(lsn).cast("long").alias(META_LSN), F.lit(False).alias(META_DELETED), F.lit(None).cast("timestamp").alias(META_UPDATED))

    written = {}
    for size in (100, 20_000):
        store = VersionedStore(spark, f"file://{tmp_path}/{size}", buckets=4, deltas=3)
        store.commit({}, 0, {"t": (states(spark.range(size), 1), ["id"])})
        total = 0
        for b in range(1, 8):
            version = store.commit({}, b, {"t": (states(spark.range(10), b + 1), ["id"])})
            total += spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(f"file://{tmp_path}/{size}/v={version}").count()
        written[size] = total
        rows = store.table("t", schema)
        assert store.current() == (8, 7) and rows.count() == size and rows.filter("id < 10").filter(f"{META_LSN} <> 8 OR v <> id * 8").count() == 0
        assert store.rows_of("t", schema, spark.range(3), ["id"]).count() == 3
        store.drop_before(8)
        assert store.table("t", schema).count() == size and store.commit({}, 3, {"t": (states(spark.range(1), 9), ["id"])}) == 8
    assert written[100] == written[20_000] <= 7 * 30


def test_no_clear_value_reaches_the_store(spark, tmp_path):
    plan = Plan("p", (TableSpec("app.accounts", "core.accounts", ("id",), (ColumnSpec("id", protect=Protection.TOKENIZE), ColumnSpec("v", Logical.INT), ColumnSpec("note", protect=Protection.ENCRYPT), ColumnSpec("card", protect=Protection.REDACT))),))
    store = VersionedStore(spark, f"file://{tmp_path}/store")
    with pytest.raises(ValueError):
        Applier(spark, plan, store)
    now = [datetime(2024, 1, 1, tzinfo=UTC)]
    applier = Applier(spark, plan, store, protect.StaticKey(bytes(range(32)), acknowledged=True), clock=lambda: now[0])

    def of(offset, key, value, table="accounts", op="c"):
        image = {"id": key, "v": value, "note": f"note of {key}", "card": "4111-clear", "other": "unplanned-clear"}
        body = {"op": op, "after": image, "source": {"schema": "app", "table": table, "lsn": offset + 1}}
        return ("t", 0, offset, json.dumps({"id": key}), json.dumps(body))

    rows = [of(0, "secret-a", "1"), of(1, "secret-b", "not a number"), of(2, "secret-c", "3", "elsewhere"), of(3, "secret-a", "2", op="u"), ("t", 0, 4, None, "{secret-broken")]
    applier.apply_batch(spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string"), 0)
    stored = applier.target("app.accounts").collect()
    assert [(r["v"], r[META_LSN], "card" in r.asDict()) for r in stored] == [(2, 4, False)]
    assert sorted((r["offset"], r["error_class"], r["status"]) for r in applier.letters().collect()) == [(1, "permanent", "quarantined"), (2, "permanent", "quarantined"), (4, "permanent", "quarantined")]
    for r in spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"file://{tmp_path}/store").select("path", "content").collect():
        held = "" if not r["path"].endswith(".parquet") else repr(spark.read.parquet(r["path"]).collect())
        for clear in ("secret", "4111-clear", "note of", "unplanned-clear"):
            assert clear not in held and clear.encode() not in bytes(r["content"])
    # Sent back and replayed: claimed first, then each with its own outcome.
    assert applier.replay() == 0
    applier.requeue(F.col("offset") == 2, "ops")
    claims = store.current()[0] + 1
    wider = Applier(spark, Plan("p", (*plan.tables, TableSpec("app.elsewhere", "core.elsewhere", ("id",), plan.tables[0].columns))), store, protect.StaticKey(bytes(range(32)), acknowledged=True), clock=lambda: now[0])
    assert wider.replay() == 1 and wider.replay() == 0
    assert wider.target("app.elsewhere").first()["v"] == 3
    letter = wider.letters().filter("offset = 2").first()
    assert (letter["status"], letter["attempts"], letter["requeued_by"]) == ("resolved", 1, "ops")
    claimed = spark.read.parquet(f"file://{tmp_path}/store/v={claims}/letters").first()
    assert claimed["status"] == "retrying"
    # A claim that never came back is taken over when its lease is over.
    store.commit({}, changes={"letters": (wider.letters().filter("offset = 1").withColumn("status", F.lit("retrying")).withColumn("next_retry_at", F.lit(now[0]).cast("timestamp")), ["topic", "partition", "offset"])})
    assert wider.replay() == 0
    now[0] += timedelta(hours=1)
    assert wider.replay() == 1 and wider.letters().filter("offset = 1").first()["status"] == "quarantined"


def test_live_window(spark, tmp_path):
    rows = [("t", 1, "row", "c1", "k1", "a"), ("t", 2, "row", "c1", "k2", "b"), ("t", 3, "row", "c1", "k3", "c"), ("t", 4, "low", "old", "", ""), ("t", 5, "event", "", "k1", ""), ("t", 6, "low", "c1", "", ""), ("t", 7, "event", "", "k2", ""), ("t", 8, "high", "c1", "", "")]
    source = tmp_path / "in"
    spark.createDataFrame(rows[:5], ENTRY).coalesce(1).write.mode("append").parquet(str(source))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def drain():
        stream = live_window(spark.readStream.schema(ENTRY).parquet(str(source)))
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    drain()
    spark.createDataFrame(rows[5:], ENTRY).coalesce(1).write.mode("append").parquet(str(source))
    drain()
    assert [(r["row_key"], r["payload"]) for r in spark.read.parquet(out).orderBy("row_key").collect()] == [("k1", "a"), ("k3", "c")]
