"""Registered queries over the provided tables, each with the SQL that it must equal."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions import canonical, digest, protect, redaction
from quaymark.operators import apply, cdc, dead_letters, gate, recon, window
from quaymark.plans import fixtures as fx
from quaymark.plans.spec import META_DELETED, META_LSN, META_UPDATED, ColumnSpec, Logical, Plan, Protection, TableSpec
from quaymark.sources import control, parts, scans
from quaymark.sources.versioned import VersionedStore
from quaymark.streaming.applier import Applier

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# What several queries' SQL begins with.
_LOG = """log AS (SELECT user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, event_id // 2 AS lsn,
    event_id AS "offset", (user_id % 8)::INTEGER AS "partition", (event_id * 7919) % 13 AS batch, value, props FROM events)"""
_NULL = "'\\x00NULL'"
_ORDER_TEXT = f"""concat_ws(chr(31), coalesce(o_orderkey::VARCHAR, {_NULL}), coalesce(o_custkey::VARCHAR, {_NULL}), coalesce(o_orderstatus, {_NULL}),
    coalesce(o_totalprice::DECIMAL(38,2)::VARCHAR, {_NULL}), coalesce(strftime(o_orderdate, '%Y-%m-%d'), {_NULL}), coalesce(rtrim(o_orderpriority), {_NULL}))"""
_SUMS = """count(*) AS row_count, coalesce(sum(('0x' || substr(h, 1, 15))::BIGINT), 0)::VARCHAR AS sum_lo, coalesce(sum(('0x' || substr(h, 17, 15))::BIGINT), 0)::VARCHAR AS sum_hi"""
_TARGET = """target AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 991 = 1 THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 997 <> 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 983 = 2)"""
_DIGESTS = f"""s AS (SELECT o_orderkey, md5({_ORDER_TEXT}) AS h FROM orders), t AS (SELECT o_orderkey, md5({_ORDER_TEXT}) AS h FROM target)"""
_FINDINGS = """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN 'missing_in_target' WHEN s.o_orderkey IS NULL THEN 'missing_in_source' ELSE 'value_mismatch' END AS kind
    FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey WHERE s.h IS DISTINCT FROM t.h"""
_LETTERS = """letters AS (SELECT event_id AS id, (['app.accounts', 'app.disputes', 'app.cards'])[event_id // 7 % 3 + 1] AS source_table,
    CASE WHEN event_id % 5 = 0 THEN (['transient', 'permanent'])[event_id // 5 % 2 + 1] END AS marker,
    CASE WHEN event_id % 5 = 1 THEN (['40001', '23505', '08006', '22003', '99999', '42P01', '0A000', '58030'])[event_id // 5 % 8 + 1] END AS state,
    CASE WHEN event_id % 5 = 2 THEN ([1213, 1062, 9999, 1452, 2013])[event_id // 5 % 5 + 1] END AS number,
    (['Connection RESET by peer', 'duplicate key value violates', 'value too long for type', 'deadlock found, data truncated', 'something odd', 'request timed out'])[event_id // 5 % 6 + 1] AS message,
    (event_id % 14)::INTEGER AS attempts, (['pending', 'retrying', 'quarantined', 'resolved', 'discarded'])[event_id // 3 % 5 + 1] AS status,
    ts AS first_seen_at, ts + to_hours((event_id % 600)::INTEGER) AS next_retry_at FROM events)"""
_TEXT_TRANSIENT = "|".join(dead_letters.TEXT_TRANSIENT)
_TEXT_PERMANENT = "|".join(dead_letters.TEXT_PERMANENT)
_LIST = lambda values: ", ".join(repr(v) for v in values)
_CLASS = f"""CASE WHEN marker IN ('transient', 'permanent') THEN marker
    WHEN state IN ({_LIST(dead_letters.STATE_TRANSIENT)}) THEN 'transient' WHEN substr(state, 1, 2) IN ({_LIST(dead_letters.STATE_CLASS_TRANSIENT)}) THEN 'transient'
    WHEN substr(state, 1, 2) IN ({_LIST(dead_letters.STATE_CLASS_PERMANENT)}) THEN 'permanent'
    WHEN number IN ({_LIST(dead_letters.NUMBER_TRANSIENT)}) THEN 'transient' WHEN number IN ({_LIST(dead_letters.NUMBER_PERMANENT)}) THEN 'permanent'
    WHEN regexp_matches(lower(message), '{_TEXT_TRANSIENT}') THEN 'transient' WHEN regexp_matches(lower(message), '{_TEXT_PERMANENT}') THEN 'permanent' ELSE 'unknown' END"""


def _strings(df: DataFrame, *columns: str) -> DataFrame:
    """Wide sums as text, in which form both engines have them."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# Digests and canonical keys


@query(f"SELECT o_orderkey, md5({_ORDER_TEXT}) AS digest FROM orders")
def row_digest_orders(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", digest.row_digest(o, fx.ORDERS.comparable()).alias("digest"))


@query(f"SELECT c_custkey, md5(concat_ws(chr(31), coalesce(c_custkey::VARCHAR, {_NULL}), coalesce(c_name, {_NULL}), coalesce(c_acctbal::DECIMAL(38,2)::VARCHAR, {_NULL}))) AS digest FROM customer")
def row_digest_customer(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    return c.select("c_custkey", digest.row_digest(c, fx.CUSTOMER.comparable()).alias("digest"))


@query(f"WITH d AS (SELECT md5({_ORDER_TEXT}) AS h FROM orders) SELECT {_SUMS} FROM d")
def range_digest_orders(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    rows = o.select(digest.row_digest(o, fx.ORDERS.comparable()).alias("d"))
    return _strings(rows.agg(*digest.range_digest(F.col("d"))), "sum_lo", "sum_hi")


_LINE = [ColumnSpec("l_orderkey", Logical.INT), ColumnSpec("l_linenumber", Logical.INT), ColumnSpec("l_extendedprice", Logical.DECIMAL, scale=2), ColumnSpec("l_shipdate", Logical.DATE)]


@query(
    f"""WITH d AS (SELECT md5(concat_ws(chr(31), coalesce(l_orderkey::VARCHAR, {_NULL}), coalesce(l_linenumber::VARCHAR, {_NULL}),
        coalesce(l_extendedprice::DECIMAL(38,2)::VARCHAR, {_NULL}), coalesce(strftime(l_shipdate, '%Y-%m-%d'), {_NULL}))) AS h FROM lineitem) SELECT {_SUMS} FROM d"""
)
def range_digest_lineitem(spark, sf_dir):
    line = fx.table(spark, sf_dir, "lineitem")
    rows = line.select(digest.row_digest(line, _LINE).alias("d"))
    return _strings(rows.agg(*digest.range_digest(F.col("d"))), "sum_lo", "sum_hi")


_EVENT = [ColumnSpec("event_id", Logical.INT), ColumnSpec("ts", Logical.TIMESTAMP), ColumnSpec("event_type"), ColumnSpec("value", Logical.DECIMAL, scale=2)]


@query(
    f"""WITH d AS (SELECT user_id, md5(concat_ws(chr(31), event_id::VARCHAR, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), coalesce(event_type, {_NULL}),
        coalesce(value::DECIMAL(38,2)::VARCHAR, {_NULL}))) AS h FROM events) SELECT user_id AS bucket, {_SUMS} FROM d GROUP BY user_id"""
)
def range_digest_events_by_user(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return _strings(recon.bucket_digests(e, e["user_id"], digest.row_digest(e, _EVENT)), "sum_lo", "sum_hi")


@query(f"WITH d AS (SELECT o_orderkey, md5({_ORDER_TEXT}) AS h FROM orders) SELECT (o_orderkey // 1000)::BIGINT AS bucket, {_SUMS} FROM d GROUP BY 1")
def bucket_digest_orders(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    found = recon.bucket_digests(o, F.floor(o["o_orderkey"] / 1000), digest.row_digest(o, fx.ORDERS.comparable()))
    return _strings(found, "sum_lo", "sum_hi")


def _order_key(o: DataFrame):
    return canonical.canonical_key({"o_orderkey": (o["o_orderkey"], T.LongType()), "o_orderstatus": (o["o_orderstatus"], T.StringType())})


@query(
    """SELECT o_orderkey, k AS row_key, rtrim(replace(replace(substr(to_base64(unhex(substr(sha256(k), 1, 18))), 1, 12), '+', '-'), '/', '_'), '=') AS key_hash FROM
       (SELECT o_orderkey, '10:o_orderkey=' || octet_length(encode(o_orderkey::VARCHAR)) || ':' || o_orderkey::VARCHAR || ';' || '13:o_orderstatus=' || octet_length(encode(o_orderstatus)) || ':' || o_orderstatus || ';' AS k FROM orders)"""
)
def row_key_canonical(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    key = _order_key(o)
    return o.select("o_orderkey", key.alias("row_key"), canonical.key_hash(key).alias("key_hash"))


@query(
    """SELECT c_custkey, (('0x' || substr(sha256('9:c_custkey=' || octet_length(encode(c_custkey::VARCHAR)) || ':' || c_custkey::VARCHAR || ';'), 1, 16))::UBIGINT % 7)::INTEGER AS part FROM customer"""
)
def row_key_partition(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    key = canonical.canonical_key({"c_custkey": (c["c_custkey"], T.LongType())})
    return c.select("c_custkey", canonical.key_partition(key, 7).alias("part"))


@query(
    """SELECT event_id, event_id::VARCHAR || '|' || CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END || '|' || CASE WHEN event_id % 5 = 0 THEN chr(0) || 'NULL' ELSE event_type END || '|' ||
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || rtrim(strftime(ts, '%f'), '0') END || 'Z' AS canonical FROM events"""
)
def canonical_values(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    i = e["event_id"]
    texts = [
        canonical.canonical_value(i.cast("double"), T.DoubleType()), canonical.canonical_value(e["user_id"] % 2 == 0, T.BooleanType()),
        canonical.canonical_value(F.when(i % 5 != 0, e["event_type"]), T.StringType()), canonical.canonical_value(e["ts"], T.TimestampType()),
    ]
    return e.select("event_id", F.concat_ws("|", *texts).alias("canonical"))


# Scans


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey > 100 AND o_orderkey <= 500")
def range_scan_half_open(spark, sf_dir):
    return scans.range_scan(fx.table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderdate"], "o_orderkey", 100, 500)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark, sf_dir):
    return scans.keyset_page(fx.table(spark, sf_dir, "orders"), "o_orderkey", 50, after=700)


@query("SELECT count(*) AS row_count FROM orders WHERE o_orderkey > 10 AND o_orderkey <= 1000")
def bounded_count(spark, sf_dir):
    return scans.bounded_count(fx.table(spark, sf_dir, "orders"), "o_orderkey", 10, 1000)


@query("SELECT (r // 500)::BIGINT AS chunk, o_orderkey AS upper_bound FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) WHERE r % 500 = 0")
def chunk_boundaries(spark, sf_dir):
    _shared(spark)
    return recon.boundaries(fx.table(spark, sf_dir, "orders"), "o_orderkey", 500)


@query(f"WITH {_LOG} SELECT DISTINCT 'app' AS topic, \"partition\" FROM log")
def partition_discovery(spark, sf_dir):
    return scans.partitions(fx.change_log(spark, sf_dir))


def _stored_offsets(log: DataFrame) -> DataFrame:
    """What was applied up to the middle, but for one partition that is new."""
    return apply.high_water_marks(log.filter("offset < 5000 AND partition <> 3"))


@query(
    f"""WITH {_LOG}, stored AS (SELECT "partition", max("offset") AS last FROM log WHERE "offset" < 5000 AND "partition" <> 3 GROUP BY 1)
        SELECT l."partition", count(*) AS unread, min("offset") AS first_unread FROM log l LEFT JOIN stored s ON l."partition" = s."partition" WHERE "offset" > coalesce(last, -1) GROUP BY 1"""
)
def start_positions(spark, sf_dir):
    log = fx.change_log(spark, sf_dir)
    return scans.unread(log, _stored_offsets(log)).groupBy("partition").agg(F.count(F.lit(1)).alias("unread"), F.min("offset").alias("first_unread"))


@query(
    f"""WITH {_LOG}, stored AS (SELECT "partition", max("offset") AS last FROM log WHERE "offset" < 5000 AND "partition" <> 3 GROUP BY 1), newest AS (SELECT "partition", max("offset") AS newest FROM log GROUP BY 1)
        SELECT 'app' AS topic, n."partition", newest, coalesce(last, -1) AS last_offset, newest - coalesce(last, -1) AS lag FROM newest n LEFT JOIN stored s ON n."partition" = s."partition" """
)
def consumer_lag(spark, sf_dir):
    log = fx.change_log(spark, sf_dir)
    return scans.consumer_lag(log, _stored_offsets(log))


@query(f"WITH d AS (SELECT o_orderkey, md5({_ORDER_TEXT}) AS digest FROM orders) SELECT * FROM d WHERE o_orderkey > 2000 AND o_orderkey <= 2100")
def row_digest_scan(spark, sf_dir):
    return scans.row_digests(fx.table(spark, sf_dir, "orders"), "o_orderkey", lambda df: digest.row_digest(df, fx.ORDERS.comparable()), 2000, 2100)


@query(
    f"""WITH {_LOG}, h AS (SELECT "offset", printf('%X', (lsn // 256)::BIGINT) || '/' || printf('%X', (lsn % 256)::BIGINT) AS slashed FROM log),
    m AS (SELECT l.*, "offset" % 101 = 7 AS empty, "offset" % 103 = 9 AS broken FROM log l)
    SELECT "offset", CASE WHEN empty OR broken THEN NULL WHEN "offset" % 3 > 0 THEN 'app.accounts' ELSE 'bank.accounts' END AS "table",
      CASE WHEN empty OR broken THEN NULL WHEN "offset" % 97 = 5 THEN 'z' ELSE op END AS op, CASE WHEN empty OR broken THEN NULL
        WHEN "offset" % 5 = 0 THEN (lsn // 256) * 4294967296 + lsn % 256 WHEN "offset" % 5 IN (1, 2) THEN lsn
        WHEN "offset" % 5 = 3 THEN (lsn % 1000) * 4294967296 + lsn ELSE lsn + 1700000000000 END AS lsn,
      user_id::VARCHAR AS row_key, CASE WHEN empty OR broken THEN false ELSE "offset" % 7 = 0 END AS snapshot, empty AS skipped,
      CASE WHEN empty THEN NULL WHEN broken THEN 'permanent: value is not a change event' WHEN "offset" % 97 = 5 THEN 'permanent: unknown operation z' END AS error FROM m"""
)
def cdc_decode_events(spark, sf_dir):
    events = cdc.decode(fx.change_messages(spark, sf_dir), {"app.accounts": ["user_id"], "bank.accounts": ["user_id"]})
    return events.select("offset", "table", "op", "lsn", F.element_at("row_key", "user_id").alias("row_key"), "snapshot", "skipped", "error")


_LSN_FORMS = ["0/1A2B3C4D", "439041101", "0x1A2B3C4D", "1A2B3C4D", " 42 ", "", "-7", "9007199254740993", "zz", "FFFFFFFF/FFFFFFFF"]


@query(
    """SELECT * FROM (VALUES ('0/1A2B3C4D', 439041101), ('439041101', 439041101), ('0x1A2B3C4D', 439041101), ('1A2B3C4D', 439041101), (' 42 ', 42), ('', NULL), ('-7', NULL),
       ('9007199254740993', 9007199254740993), ('zz', NULL), ('FFFFFFFF/FFFFFFFF', -1)) AS v(form, lsn)"""
)
def lsn_folding(spark, sf_dir):
    forms = spark.createDataFrame([(f,) for f in _LSN_FORMS], "form string")
    return forms.select("form", cdc.bits_of(F.col("form")).alias("lsn"))


@query(
    """SELECT (event_id // 100)::VARCHAR AS chunk_id, CASE WHEN event_id % 100 = 10 THEN 'low' ELSE 'high' END AS kind, 'app.accounts' AS data_table, event_id AS lsn FROM events WHERE event_id % 100 IN (10, 60)"""
)
def watermark_routing(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    i = F.col("event_id")
    mark = i % 100 == 10
    is_mark = mark | (i % 100 == 60)
    row = F.create_map(F.lit("chunk_id"), F.floor(i / 100).cast("string"), F.lit("kind"), F.when(mark, "low").when(i % 100 == 60, "high").otherwise("none"), F.lit("table_name"), F.lit("app.accounts"))
    stream = e.select(F.when(is_mark | (i % 100 == 20), "ctl.signals").otherwise("app.accounts").alias("table"), row.alias("after"), F.lit(None).cast("map<string,string>").alias("before"), i.alias("lsn"))
    return cdc.watermarks(stream, "ctl.signals")


@query("SELECT event_id, greatest(0.0, (event_id % 7 - 2) * 1.5)::DOUBLE AS lag FROM events")
def replication_lag(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    committed = F.timestamp_micros(F.unix_micros("ts") - ((F.col("event_id") % 7 - 2) * 1_500_000))
    return e.select("event_id", cdc.lag_seconds(F.col("ts"), committed).alias("lag"))


# Apply


@query(f'WITH {_LOG} SELECT user_id, op, lsn, "offset", value, props FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, "offset" DESC) = 1')
def coalesce_latest(spark, sf_dir):
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "offset", "value", "props")
    return apply.coalesce_newest(log, ["user_id"], ["lsn", "offset"])


@query(f"""WITH {_LOG} SELECT 'app' AS topic, "partition", max("offset") AS last_offset, arg_max(lsn, "offset") AS last_lsn FROM log GROUP BY "partition" """)
def high_water_marks(spark, sf_dir):
    return apply.high_water_marks(fx.change_log(spark, sf_dir))


_ORDER = ["lsn", "batch", "offset"]


@query(
    f"""WITH {_LOG} SELECT user_id, value, props, lsn AS _mig_lsn FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, batch DESC, "offset" DESC) = 1 AND op <> 'd'"""
)
def fence_upsert_state(spark, sf_dir):
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset", "value", "props")
    return apply.purge_tombstones(apply.settled_state(log, ["user_id"], _ORDER)).drop(META_DELETED)


def _empty_target(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"user_id long, value double, props string, {META_LSN} long, {META_DELETED} boolean, {META_UPDATED} timestamp")


@query(f"""WITH {_LOG} SELECT user_id, lsn AS _mig_lsn FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, batch DESC, "offset" DESC) = 1 AND op = 'd'""")
def tombstone_state(spark, sf_dir):
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset")
    return apply.settled_state(log, ["user_id"], _ORDER).filter(META_DELETED).select("user_id", META_LSN)


@query(
    f"""WITH {_LOG}, w AS (SELECT user_id, batch, max(lsn) AS lsn FROM log GROUP BY user_id, batch),
        f AS (SELECT *, max(lsn) OVER (PARTITION BY user_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored_lsn FROM w)
        SELECT user_id, batch, lsn, stored_lsn FROM f WHERE stored_lsn > lsn"""
)
def fence_rejected_writes(spark, sf_dir):
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset")
    return apply.fence_decisions(log, ["user_id"], "batch", ["lsn", "offset"]).filter(~F.col("accepted")).select("user_id", "batch", "lsn", "stored_lsn")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_quantity) = 1""")
def staging_dedupe(spark, sf_dir):
    part = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_quantity")
    return apply.dedupe_part(part, ["l_orderkey", "l_linenumber"])


@query(
    f"""WITH {_LOG}, t AS (SELECT user_id, value, lsn, op = 'd' AS dead FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, batch DESC, "offset" DESC) = 1),
        p AS (SELECT user_id, min(value) AS value FROM events GROUP BY user_id)
        SELECT user_id, CASE WHEN lsn <= 4950 THEN p.value WHEN dead THEN NULL ELSE t.value END AS value, CASE WHEN lsn <= 4950 THEN 4950 ELSE lsn END AS _mig_lsn, dead AS _mig_deleted
        FROM t JOIN p USING (user_id) UNION ALL SELECT user_id + 1000000, value, 4950, false FROM p WHERE user_id % 3 = 0"""
)
def staging_merge(spark, sf_dir):
    """A part extracted in the middle of the log: newer rows stay, older ones are replaced, tombstones stay tombstones."""
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset", "value")
    target = apply.settled_state(log, ["user_id"], _ORDER).withColumn(META_UPDATED, F.lit(None).cast("timestamp"))
    rows = fx.table(spark, sf_dir, "events").select("user_id", "value")
    part = rows.unionByName(rows.filter("user_id % 3 = 0").withColumn("user_id", F.col("user_id") + 1_000_000))
    return apply.merge_part(target, part, ["user_id"], ["value"], 4950, F.timestamp_seconds(F.lit(0))).drop(META_UPDATED)


#: All batches of the log, out of order.
_BATCHES = [b * 5 % 13 for b in range(13)]


def _shared(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session, as in tests, may do without."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="quaymark-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found.rstrip("/")


def _checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read again."""
    _shared(df.sparkSession)
    return df.checkpoint()


@query(
    f"""WITH {_LOG}, a AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, batch DESC, "offset" DESC) = 1)
        SELECT user_id, CASE WHEN op = 'd' THEN NULL ELSE value END AS value, lsn AS _mig_lsn, op = 'd' AS _mig_deleted FROM a"""
)
def fence_merge_batches(spark, sf_dir):
    """All batches applied one after the other by the merge that the applier uses, the target written between them."""
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset", "value", "props")
    target = _empty_target(spark)
    for b in range(13):
        newest = apply.coalesce_newest(log.filter(F.col("batch") == b), ["user_id"], ["lsn", "offset"])
        target = _checkpointed(apply.fence_merge(target, newest, ["user_id"], ["value", "props"], F.timestamp_seconds(F.lit(b))))
    return target.select("user_id", F.when(~F.col(META_DELETED), F.col("value")).alias("value"), META_LSN, META_DELETED)


@query(f"""WITH {_LOG} SELECT 'app' AS topic, "partition", max("offset") AS last_offset, arg_max(lsn, "offset") AS last_lsn FROM log GROUP BY 2""")
def offset_upsert_monotonic(spark, sf_dir):
    """Offsets advanced over all batches, out of order."""
    log = fx.change_log(spark, sf_dir)
    stored = apply.high_water_marks(log.filter(F.col("batch") == _BATCHES[0]))
    for b in _BATCHES[1:]:
        stored = _checkpointed(apply.advance_offsets(stored, apply.high_water_marks(log.filter(F.col("batch") == b)), ["topic", "partition"]))
    return stored


@query(f"""WITH {_LOG}, t AS (SELECT op = 'd' AS dead FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, batch DESC, "offset" DESC) = 1) SELECT count(*) FILTER (NOT dead) AS live_rows FROM t""")
def purge_tombstones(spark, sf_dir):
    log = fx.change_log(spark, sf_dir).select("user_id", "op", "lsn", "batch", "offset")
    return apply.purge_tombstones(apply.settled_state(log, ["user_id"], _ORDER)).agg(F.count(F.lit(1)).alias("live_rows"))


@query("""SELECT event_type, count(*) AS events FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1""")
def unknown_tables(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(F.concat(F.lit("app."), "event_type").alias("table"), "event_type")
    return apply.split_known(events, ["app.click", "app.view"])[1].groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


# Verification


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return fx.table(spark, sf_dir, "orders"), fx.orders_target(spark, sf_dir)


def _findings(spark, sf_dir) -> DataFrame:
    source, target = _sides(spark, sf_dir)
    return recon.reconcile(source, target, "o_orderkey", lambda df: digest.row_digest(df, fx.ORDERS.comparable()), lambda k: F.floor(k / 5000))


@query(f"WITH {_TARGET}, {_DIGESTS} {_FINDINGS}")
def recon_findings(spark, sf_dir):
    return _findings(spark, sf_dir)


@query(f"WITH {_TARGET}, {_DIGESTS}, f AS ({_FINDINGS}) SELECT o_orderkey FROM f WHERE kind = 'missing_in_target'")
def recon_missing_in_target(spark, sf_dir):
    return _findings(spark, sf_dir).filter("kind = 'missing_in_target'").select("o_orderkey")


@query(f"WITH {_TARGET}, {_DIGESTS}, f AS ({_FINDINGS}) SELECT o_orderkey FROM f WHERE kind = 'missing_in_source'")
def recon_missing_in_source(spark, sf_dir):
    return _findings(spark, sf_dir).filter("kind = 'missing_in_source'").select("o_orderkey")


@query(f"WITH {_TARGET}, {_DIGESTS}, f AS ({_FINDINGS}) SELECT o_orderkey FROM f WHERE kind = 'value_mismatch'")
def recon_value_mismatch(spark, sf_dir):
    return _findings(spark, sf_dir).filter("kind = 'value_mismatch'").select("o_orderkey")


@query(f"WITH {_TARGET}, {_DIGESTS}, f AS ({_FINDINGS}) SELECT kind, count(*) AS findings, kind <> 'missing_in_source' AS repairable FROM f GROUP BY kind")
def recon_summary(spark, sf_dir):
    return recon.summary(_findings(spark, sf_dir))


@query(
    f"""WITH {_TARGET}, {_DIGESTS}, sb AS (SELECT (o_orderkey // 5000)::BIGINT AS bucket, {_SUMS} FROM s GROUP BY 1), tb AS (SELECT (o_orderkey // 5000)::BIGINT AS bucket, {_SUMS} FROM t GROUP BY 1)
        SELECT coalesce(sb.bucket, tb.bucket) AS bucket, coalesce(sb.row_count, 0) AS source_rows, coalesce(tb.row_count, 0) AS target_rows FROM sb FULL JOIN tb ON sb.bucket = tb.bucket
        WHERE (sb.row_count, sb.sum_lo, sb.sum_hi) IS DISTINCT FROM (tb.row_count, tb.sum_lo, tb.sum_hi)"""
)
def recon_differing_buckets(spark, sf_dir):
    made = [recon.bucket_digests(df, F.floor(df["o_orderkey"] / 5000), digest.row_digest(df, fx.ORDERS.comparable())) for df in _sides(spark, sf_dir)]
    return recon.differing_buckets(*made)


# Chunks of all events, marks of every chunk that there is.
# A recorded run over a plan of two tables; of each at most so many findings, in order.

_RECON_BUDGET = 30
_RUN_AT = "2024-02-01"
_PLAN_FINDINGS = f"""{_TARGET}, {_DIGESTS}, f AS ({_FINDINGS}),
    k AS (SELECT kind, '10:o_orderkey=' || octet_length(encode(o_orderkey::VARCHAR)) || ':' || o_orderkey::VARCHAR || ';' AS row_key FROM f),
    o AS (SELECT kind, row_key, rtrim(replace(replace(substr(to_base64(unhex(substr(sha256(row_key), 1, 18))), 1, 12), '+', '-'), '/', '_'), '=') AS key_hash FROM k),
    kept AS (SELECT * FROM o QUALIFY row_number() OVER (ORDER BY key_hash, kind = 'missing_in_source', row_key) <= {_RECON_BUDGET})"""


def _plan_run(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    _shared(spark)
    plain = TableSpec("crm.customer", "crm.customer", ("c_custkey",), (ColumnSpec("c_custkey", Logical.INT), ColumnSpec("c_name")))
    c, o = fx.table(spark, sf_dir, "customer"), fx.table(spark, sf_dir, "orders")
    sides = {"crm.customer": (c, c), "tpch.orders": (o, fx.orders_target(spark, sf_dir))}
    return recon.verify_plan(Plan("p", (plain, fx.ORDERS)), sides, "run-1", "m", F.lit(_RUN_AT).cast("timestamp"), budget=_RECON_BUDGET, buckets=64)


@query(f"""WITH {_PLAN_FINDINGS} SELECT 'tpch.orders' AS source_table, (SELECT count(*) FROM o) <= {_RECON_BUDGET} AS complete, (SELECT count(*) FROM kept)::INTEGER AS findings, 2 AS digests
    UNION ALL SELECT 'crm.customer', true, 0, 2""")  # fmt: skip
def recon_plan_runs(spark, sf_dir):
    return _plan_run(spark, sf_dir)[0].select("source_table", "complete", "findings", "digests")


@query(f"WITH {_PLAN_FINDINGS} SELECT 'run-1' AS run_id, kind, key_hash, row_key FROM kept")
def recon_plan_findings(spark, sf_dir):
    return _plan_run(spark, sf_dir)[1].select("run_id", "kind", "key_hash", "row_key")


@query(f"WITH {_PLAN_FINDINGS} SELECT kind, count(*) AS findings, epoch_us(TIMESTAMP '{_RUN_AT}') AS first_seen, kind <> 'missing_in_source' AS repairable FROM kept GROUP BY kind")
def recon_plan_summary(spark, sf_dir):
    return recon.summary(_plan_run(spark, sf_dir)[1]).withColumn("first_seen", F.unix_micros("first_seen_at")).drop("first_seen_at")


_CHUNKS = """chunk AS (SELECT (event_id // 1000)::VARCHAR AS chunk_id, event_id AS ord, user_id, value FROM events),
    marks AS (SELECT DISTINCT (event_id // 1000 * 1000)::BIGINT + 300 AS low, (event_id // 1000 * 1000)::BIGINT + 420 AS high, (event_id // 1000)::VARCHAR AS chunk_id FROM events),
    gone AS (SELECT c.chunk_id, c.ord FROM chunk c JOIN marks m USING (chunk_id) WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.user_id AND e.event_id > m.low AND e.event_id < m.high))"""


def _window(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = fx.table(spark, sf_dir, "events")
    i = F.col("event_id")
    chunk = e.select(F.floor(i / 1000).cast("string").alias("chunk_id"), i.alias("ord"), "user_id", "value")
    at = F.col("chunk_id").cast("long") * 1000
    marks = chunk.select("chunk_id").distinct().select("chunk_id", (at + 300).alias("low"), (at + 420).alias("high"))
    return chunk, window.survivors(chunk, e.select("user_id", i.alias("lsn")), marks, ["user_id"])


@query(f"WITH {_CHUNKS} SELECT c.* FROM chunk c LEFT JOIN gone g ON c.chunk_id = g.chunk_id AND c.ord = g.ord WHERE g.ord IS NULL")
def window_eviction(spark, sf_dir):
    return _window(spark, sf_dir)[1]


@query(
    f"""WITH {_CHUNKS} SELECT c.chunk_id, count(*) AS rows_buffered, count(*) - count(g.ord) AS rows_emitted, count(g.ord) AS rows_evicted
        FROM chunk c LEFT JOIN gone g ON c.chunk_id = g.chunk_id AND c.ord = g.ord GROUP BY 1"""
)
def window_stats(spark, sf_dir):
    return window.stats(*_window(spark, sf_dir))


@query(f"WITH {_CHUNKS} SELECT DISTINCT chunk_id, 'chunk has a key twice; chunk boundaries overlap' AS problem FROM (SELECT chunk_id, user_id FROM chunk GROUP BY ALL HAVING count(*) > 1)")
def window_rejections(spark, sf_dir):
    return window.problems(_window(spark, sf_dir)[0], ["user_id"])


@query(
    """WITH c AS (SELECT DISTINCT event_id // 50 AS c FROM events), m AS (SELECT 'app.t' || (c % 2) AS data_table, c::VARCHAR AS chunk_id, c * 50 + 10 AS low, c * 50 + 20 + CASE WHEN c % 5 = 0 THEN 130 ELSE 0 END AS high FROM c)
       SELECT data_table, chunk_id, 'another chunk of the table is open' AS problem FROM m QUALIFY low < max(high) OVER (PARTITION BY data_table ORDER BY low, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def window_busy(spark, sf_dir):
    c = F.col("c")
    chunks = fx.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 50).alias("c")).distinct()
    high = c * 50 + 20 + F.when(c % 5 == 0, 130).otherwise(0)
    return window.busy(chunks.select(F.concat(F.lit("app.t"), c % 2).alias("data_table"), c.cast("string").alias("chunk_id"), (c * 50 + 10).alias("low"), high.alias("high")), "data_table")


# Protection. Keys of these queries are for tests.

_MASTER = bytes(range(32))


def _token_key() -> bytes:
    return protect.StaticKey(_MASTER, acknowledged=True).key(protect.PURPOSE_TOKEN)


def _encrypt_key() -> bytes:
    return protect.StaticKey(_MASTER, acknowledged=True).key(protect.PURPOSE_ENCRYPT)


def _token_sql(column: str, name: str) -> str:
    pads = [bytes(b ^ x for b in _token_key().ljust(64, b"\0")).hex() for x in (0x36, 0x5C)]
    framed = (len(name).to_bytes(8, "big") + name.encode()).hex()
    mac = f"sha256(unhex('{pads[1]}') || unhex(sha256(unhex('{pads[0]}{framed}') || encode({column}))))"
    letter = f"substr('{protect.BASE32}', ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER + 1, 1)"
    return f"(SELECT string_agg({letter}, '' ORDER BY i) FROM (SELECT {mac} AS h), range(32) r(i))"


@query(f"SELECT c_custkey, {_token_sql('c_name', 'crm.customer.c_name')} AS token FROM customer")
def protect_tokenize_opaque(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    return c.select("c_custkey", protect.token(_token_key(), "crm.customer.c_name", c["c_name"]).alias("token"))


@query(f"SELECT {_token_sql('c_custkey::VARCHAR', 'crm.customer.c_custkey')} AS c_custkey, {_token_sql('c_name', 'crm.customer.c_name')} AS name, c_acctbal FROM customer")
def protect_redact_prune(spark, sf_dir):
    return protect.protect(fx.table(spark, sf_dir, "customer"), fx.CUSTOMER, _token_key(), _encrypt_key())


# The applier over all messages, in a store of its own.

ACCOUNTS = TableSpec("app.accounts", "core.accounts", ("user_id",), (ColumnSpec("user_id", protect=Protection.TOKENIZE), ColumnSpec("value", Logical.DECIMAL, "amount", scale=2)))
BANK = TableSpec("bank.accounts", "bank.accounts", ("user_id",), ACCOUNTS.columns)
_MESSAGES = """m AS (SELECT l.*, "offset" % 101 = 7 AS empty, "offset" % 103 = 9 AS broken, "offset" % 97 = 5 AS odd, "offset" % 3 > 0 AS planned,
      CASE "offset" % 5 WHEN 0 THEN (lsn // 256) * 4294967296 + lsn % 256 WHEN 3 THEN (lsn % 1000) * 4294967296 + lsn WHEN 4 THEN lsn + 1700000000000 ELSE lsn END AS number FROM log l)"""


def _applied(spark: SparkSession, sf_dir: str, plan: Plan) -> Applier:
    """An applier that has applied all messages in two batches, the later ones first."""
    folder = f"{_shared(spark)}/quaymark/applied-{uuid.uuid4().hex}"
    applier = Applier(spark, plan, VersionedStore(spark, folder, buckets=8), protect.StaticKey(_MASTER, acknowledged=True), clock=lambda: datetime(2024, 5, 1, tzinfo=UTC))
    messages = fx.change_messages(spark, sf_dir)
    half = messages.agg(F.floor(F.max("offset") / 2)).first()[0] or 0
    applier.apply_batch(messages.filter(F.col("offset") > half), 0)
    applier.apply_batch(messages.filter(F.col("offset") <= half), 1)
    return applier


@query(
    f"""WITH {_LOG}, {_MESSAGES}, g AS (SELECT * FROM m WHERE NOT empty AND NOT broken AND NOT odd AND planned), h AS (SELECT max("offset") // 2 AS half FROM log)
      SELECT {_token_sql('user_id::VARCHAR', 'app.accounts.user_id')} AS user_id, CASE WHEN op <> 'd' THEN value::DECIMAL(38,2) END AS amount, number AS _mig_lsn, op = 'd' AS _mig_deleted
      FROM g, h QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY number DESC, "offset" <= half DESC, "offset" DESC) = 1"""
)
def applier_protected_state(spark, sf_dir):
    """The target table after all messages: keys are tokens, amounts decimals; the payload of tombstones depends on the path."""
    rows = _applied(spark, sf_dir, Plan("p", (ACCOUNTS,))).target("app.accounts")
    return rows.select("user_id", F.when(~F.col(META_DELETED), F.col("amount")).alias("amount"), META_LSN, META_DELETED)


@query(
    f"""WITH {_LOG}, {_MESSAGES} SELECT "offset", CASE WHEN broken THEN NULL WHEN planned THEN 'app.accounts' ELSE 'bank.accounts' END AS source_table,
      CASE WHEN NOT broken AND planned THEN {_token_sql('user_id::VARCHAR', 'app.accounts.user_id')} END AS token, 'permanent' AS error_class, 'quarantined' AS status, 1 AS attempts, true AS sealed
      FROM m WHERE NOT empty AND (broken OR odd OR NOT planned)"""
)
def applier_dead_letters(spark, sf_dir):
    """Letters of all messages that couldn't be applied; their messages are sealed, keys of planned tables are tokens."""
    letters = _applied(spark, sf_dir, Plan("p", (ACCOUNTS,))).letters()
    key = F.element_at(F.from_json("row_key", "map<string,string>"), "user_id")
    return letters.select("offset", "source_table", key.alias("token"), "error_class", "status", "attempts", protect.is_ciphertext(F.col("payload")).alias("sealed"))


@query(
    f"""WITH {_LOG}, {_MESSAGES}, g AS (SELECT * FROM m WHERE NOT empty AND NOT broken AND NOT odd AND NOT planned),
      r AS (SELECT 'row' AS kind, {_token_sql('user_id::VARCHAR', 'bank.accounts.user_id')} AS name, number AS n FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY number DESC, "offset" DESC) = 1)
      SELECT * FROM r UNION ALL SELECT 'letter', CASE WHEN broken OR odd THEN 'quarantined' ELSE 'resolved' END, count(*) FROM m WHERE NOT empty AND (broken OR odd OR NOT planned) GROUP BY 2"""
)
def applier_replay(spark, sf_dir):
    """All letters sent back and replayed under a plan that has the table: its rows, and how many letters ended how."""
    first = _applied(spark, sf_dir, Plan("p", (ACCOUNTS,)))
    again = Applier(spark, Plan("p", (ACCOUNTS, BANK)), first.store, protect.StaticKey(_MASTER, acknowledged=True), clock=first.clock)
    again.requeue(F.lit(True), "ops")
    while again.replay(limit=1 << 20):
        pass
    rows = again.target("bank.accounts").select(F.lit("row").alias("kind"), F.col("user_id").alias("name"), F.col(META_LSN).alias("n"))
    return rows.unionByName(again.letters().groupBy(F.lit("letter").alias("kind"), F.col("status").alias("name")).agg(F.count(F.lit(1)).alias("n")))


@query("SELECT c_custkey, length(c_name) AS n, regexp_replace(regexp_replace(c_name, '[A-Za-z]', 'a', 'g'), '[0-9]', '0', 'g') AS shape FROM customer")
def token_shape(spark, sf_dir):
    """Tokens differ from names but have their shape."""
    c = fx.table(spark, sf_dir, "customer")
    made = c.select("c_custkey", "c_name", protect.token(_token_key(), "crm.customer.c_name", c["c_name"], protect.SHAPE).alias("t"))
    return made.filter("t <> c_name").select("c_custkey", F.length("t").cast("long").alias("n"), F.regexp_replace(F.regexp_replace("t", "[A-Za-z]", "a"), "[0-9]", "0").alias("shape"))


@query("SELECT c_custkey, c_name AS opened, true AS sealed, true AS same_again, NULL::VARCHAR AS elsewhere FROM customer")
def encrypt_roundtrip(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    key, name = _encrypt_key(), "crm.customer.c_name"
    made = c.select("c_custkey", protect.encrypt(key, name, c["c_name"]).alias("r"), protect.encrypt_deterministic(key, name, c["c_name"]).alias("d"), protect.encrypt_deterministic(key, name, c["c_name"]).alias("e"))
    same = protect.decrypt(key, name, F.col("d"))
    return made.select("c_custkey", same.alias("opened"), (protect.is_ciphertext(F.col("r")) & (protect.decrypt(key, name, F.col("r")) == same)).alias("sealed"), (F.col("d") == F.col("e")).alias("same_again"), protect.decrypt(key, "crm.other.c_name", F.col("d")).alias("elsewhere"))


@query("SELECT c_custkey, c_custkey % 2 = 0 AS verified FROM customer")
def verify_token(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    key, name = _token_key(), "crm.customer.c_name"
    given = protect.token(key, name, F.when(c["c_custkey"] % 2 == 0, c["c_name"]).otherwise("another"))
    return c.select("c_custkey", protect.verify_token(key, name, c["c_name"], given).alias("verified"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[redacted]' ELSE event_type END AS first, '[redacted]' AS payload, user_id::VARCHAR AS user_id FROM events")
def log_redaction(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    name = F.when(F.col("event_id") % 2 == 0, "Password").otherwise("kind")
    attributes = redaction.redact(F.create_map(name, F.col("event_type"), F.lit("payload"), F.col("props"), F.lit("user_id"), F.col("user_id").cast("string")))
    return e.select("event_id", attributes.alias("m"), name.alias("n")).select("event_id", F.expr("m[n]").alias("first"), F.expr("m['payload']").alias("payload"), F.expr("m['user_id']").alias("user_id"))


# Dead letters


def _classified(spark, sf_dir) -> DataFrame:
    rows = fx.letters(spark, sf_dir)
    return rows.withColumn("error_class", dead_letters.classify(F.col("marker"), F.col("state"), F.col("number"), F.col("message")))


@query(f"WITH {_LETTERS} SELECT id, {_CLASS} AS error_class FROM letters")
def error_classification(spark, sf_dir):
    return _classified(spark, sf_dir).select("id", "error_class")


@query(
    f"""WITH {_LETTERS}, c AS (SELECT *, {_CLASS} AS error_class FROM letters), d AS (SELECT *, error_class = 'permanent' OR attempts + 1 >= 12 AS done FROM c)
        SELECT id, attempts + 1 AS new_attempts, CASE WHEN done THEN 'quarantined' ELSE 'pending' END AS new_status, CASE WHEN NOT done THEN least(7200, 30 * pow(3, attempts)) END AS delay_seconds FROM d"""
)
def dlq_evaluate(spark, sf_dir):
    return dead_letters.evaluate(_classified(spark, sf_dir)).select("id", "new_attempts", "new_status", "delay_seconds")


@query(f"""WITH {_LETTERS} SELECT id, {_CLASS} AS error_class, CASE WHEN error_class = 'permanent' THEN 'quarantined' ELSE 'pending' END AS status, 1 AS attempts, CASE WHEN error_class <> 'permanent' THEN 30.0::DOUBLE END AS wait FROM letters""")
def dlq_new_entries(spark, sf_dir):
    made = dead_letters.new_letters(_classified(spark, sf_dir), F.col("first_seen_at"))
    return made.select("id", "error_class", "status", "attempts", ((F.unix_micros("next_retry_at") - F.unix_micros("first_seen_at")) / 1e6).alias("wait"))


@query(f"WITH {_LETTERS} SELECT id, source_table, attempts FROM letters WHERE status = 'pending' AND next_retry_at <= TIMESTAMP '2024-02-01' ORDER BY next_retry_at, id LIMIT 100")
def dlq_claim_due(spark, sf_dir):
    return dead_letters.claim_due(fx.letters(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"), 100).select("id", "source_table", "attempts")


@query(
    f"""WITH {_LETTERS} SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'retrying') AS retrying, count(*) FILTER (status = 'quarantined') AS quarantined,
        count(*) FILTER (status = 'resolved') AS resolved, count(*) FILTER (status = 'discarded') AS discarded, count(*) FILTER (status IN ('pending', 'retrying', 'quarantined')) AS open,
        epoch_us(min(first_seen_at) FILTER (status IN ('pending', 'retrying', 'quarantined'))) AS oldest_open FROM letters"""
)
def dlq_counts(spark, sf_dir):
    return dead_letters.counts(fx.letters(spark, sf_dir)).withColumn("oldest_open", F.unix_micros("oldest_open_at")).drop("oldest_open_at")


@query(
    f"""WITH {_LETTERS} SELECT status, {_CLASS} AS error_class, source_table, count(*) AS letters, epoch_us(min(first_seen_at)) AS first_seen FROM letters
        WHERE status IN ('pending', 'retrying', 'quarantined') GROUP BY 1, 2, 3"""
)
def dlq_triage(spark, sf_dir):
    return dead_letters.triage(_classified(spark, sf_dir)).withColumn("first_seen", F.unix_micros("first_seen_at")).drop("first_seen_at")


@query(f"WITH {_LETTERS} SELECT id, CASE WHEN id % 4 = 0 AND status = 'quarantined' THEN 'pending' ELSE status END AS status, CASE WHEN id % 4 = 0 AND status = 'quarantined' THEN 0 ELSE attempts END AS attempts, CASE WHEN id % 4 = 0 AND status = 'quarantined' THEN 'ops' END AS requeued_by FROM letters")
def dlq_requeue(spark, sf_dir):
    return dead_letters.requeue(fx.letters(spark, sf_dir), F.col("id") % 4 == 0, "ops").select("id", "status", "attempts", "requeued_by")


@query("SELECT i::INTEGER AS attempt, least(30.0, 0.1 * pow(2, greatest(i, 1) - 1)) AS apply_delay, least(7200.0, 30 * pow(3, greatest(i, 1) - 1)) AS letter_delay, i >= 8 AS apply_exhausted FROM range(-1, 16) r(i)")
def backoff_schedule(spark, sf_dir):
    n = spark.range(-1, 16).select(F.col("id").cast("int").alias("attempt"))
    a, b = dead_letters.APPLY_RETRY, dead_letters.LETTER_RETRY
    return n.select("attempt", a.delay(F.col("attempt")).alias("apply_delay"), b.delay(F.col("attempt")).alias("letter_delay"), a.exhausted(F.col("attempt")).alias("apply_exhausted"))


# Gate

_ALLOWED = ", ".join(f"('{a}', '{b}')" for a, after in gate.TRANSITIONS.items() for b in (a, *after))
_PHASES = ", ".join(f"('{a}')" for a in gate.TRANSITIONS)


@query(f"WITH p(phase) AS (VALUES {_PHASES}), ok(a, b) AS (VALUES {_ALLOWED}) SELECT x.phase, y.phase AS next_phase, EXISTS (SELECT 1 FROM ok WHERE a = x.phase AND b = y.phase) AS allowed FROM p x, p y")
def phase_transitions(spark, sf_dir):
    return gate.transitions(spark)


_OBSERVED = """o AS (SELECT event_id, (['streaming', 'verifying', 'ready_for_cutover', 'loading', 'planning'])[event_id % 5 + 1] AS phase, (event_id % 21)::DOUBLE AS lag, (event_id % 1800)::DOUBLE AS lag_under_for,
    CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END AS open_letters, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS findings, event_id % 6 > 0 AS recon_complete,
    CASE WHEN event_id % 10 > 0 THEN (event_id % 3600)::DOUBLE END AS recon_age, 10 AS parts_total, 10 - event_id % 2 AS parts_loaded, event_id % 7 > 0 AS reverse_armed FROM events)"""


def _observed(spark, sf_dir) -> DataFrame:
    i = F.col("event_id")
    e = fx.table(spark, sf_dir, "events")
    return e.select(
        "event_id", F.element_at(F.array(*map(F.lit, ["streaming", "verifying", "ready_for_cutover", "loading", "planning"])), (i % 5 + 1).cast("int")).alias("phase"), (i % 21).cast("double").alias("lag"),
        (i % 1800).cast("double").alias("lag_under_for"), F.when(i % 3 == 0, 2).otherwise(0).alias("open_letters"), F.when(i % 4 == 0, 1).otherwise(0).alias("findings"), (i % 6 > 0).alias("recon_complete"),
        F.when(i % 10 > 0, (i % 3600).cast("double")).alias("recon_age"), F.lit(10).alias("parts_total"), (10 - i % 2).alias("parts_loaded"), (i % 7 > 0).alias("reverse_armed"),
    )


@query(
    f"""WITH {_OBSERVED}, b AS (SELECT event_id, list_sort(list_filter([CASE WHEN phase NOT IN ('streaming', 'verifying', 'ready_for_cutover') THEN 'wrong_phase' END, CASE WHEN lag > 10 THEN 'lag_above_threshold' END,
        CASE WHEN lag <= 10 AND lag_under_for < 900 THEN 'lag_not_stable_long_enough' END, CASE WHEN open_letters > 0 THEN 'open_dead_letters' END, CASE WHEN findings > 0 THEN 'reconciliation_findings' END,
        CASE WHEN NOT recon_complete THEN 'reconciliation_incomplete' END, CASE WHEN recon_complete AND (recon_age IS NULL OR recon_age > 1800) THEN 'reconciliation_stale' END,
        CASE WHEN parts_loaded < parts_total THEN 'parts_not_loaded' END, CASE WHEN NOT reverse_armed THEN 'reverse_replication_not_armed' END], lambda x: x IS NOT NULL)) AS l FROM o)
        SELECT event_id, array_to_string(l, ',') AS blockers, len(l) = 0 AS ready FROM b"""
)
def cutover_blockers(spark, sf_dir):
    return gate.blockers(_observed(spark, sf_dir)).select("event_id", F.concat_ws(",", "blockers").alias("blockers"), "ready")


@query(
    f"""WITH {_LETTERS}, {_PLAN_FINDINGS}, e AS (SELECT max(event_id % 3600)::DOUBLE AS under FROM events),
      p AS (SELECT count(DISTINCT o_orderkey // 1000) AS total, count(DISTINCT o_orderkey // 1000) FILTER ((o_orderkey // 1000) % 7 <> 3 AND (o_orderkey // 1000) % 3 = 0) AS loaded FROM orders)
      SELECT 'm' AS migration_id, false AS ready, 409 AS code, array_to_string(list_sort(list_filter([CASE WHEN e.under < 900 THEN 'lag_not_stable_long_enough' END,
        CASE WHEN (SELECT count(*) FROM letters WHERE status IN ('pending', 'retrying', 'quarantined')) > 0 THEN 'open_dead_letters' END, CASE WHEN (SELECT count(*) FROM kept) > 0 THEN 'reconciliation_findings' END,
        CASE WHEN (SELECT count(*) FROM o) > {_RECON_BUDGET} THEN 'reconciliation_incomplete' END, CASE WHEN (SELECT count(*) FROM o) <= {_RECON_BUDGET} THEN 'reconciliation_stale' END, CASE WHEN p.loaded < p.total THEN 'parts_not_loaded' END,
        'reverse_replication_not_armed'], lambda x: x IS NOT NULL)), ',') AS blockers FROM e, p
      UNION ALL SELECT 'new', false, 409, 'lag_above_threshold,reconciliation_incomplete,reverse_replication_not_armed,wrong_phase'"""
)
def cutover_readiness(spark, sf_dir):
    """Readiness of two migrations, from letters, parts, a recorded run and lag: one under way, one that has only been planned."""
    states = spark.createDataFrame([("m", "verifying", 0, 0, False, None), ("new", "planning", 0, 0, False, None)], control.SCHEMAS["migration_state"])
    parts_ = fx.order_parts(spark, sf_dir)
    total = F.when(F.col("migration_id") == "m", F.lit(parts_.count())).otherwise(F.lit(0)).cast("int")
    letters = fx.letters(spark, sf_dir).withColumn("migration_id", F.lit("m"))
    lag = fx.table(spark, sf_dir, "events").agg(F.lit("m").alias("migration_id"), F.lit(3.0).alias("lag"), F.max(F.col("event_id") % 3600).cast("double").alias("lag_under_for"))
    observed = gate.status(states.withColumn("parts_total", total), parts_.withColumn("migration_id", F.lit("m")), letters, _plan_run(spark, sf_dir)[0], lag, F.lit("2024-03-01").cast("timestamp"))
    return gate.readiness(observed).withColumn("blockers", F.concat_ws(",", "blockers"))


@query(
    f"""SELECT event_type, count(value) AS samples, round(sum(value), 2) AS total, arg_max(value, (ts, value)) AS last,
        array_to_string([{', '.join(f"count(*) FILTER (value <= {b})" for b in gate.BUCKETS)}, count(value)], ',') AS buckets FROM events GROUP BY 1"""
)
def metrics_by_type(spark, sf_dir):
    found = gate.metrics(fx.table(spark, sf_dir, "events").withColumn("at", F.col("ts")), ["event_type"], "value", gate.BUCKETS)
    return found.withColumn("total", F.round("total", 2)).withColumn("buckets", F.array_join(F.transform("buckets", lambda x: x.cast("string")), ","))


@query("SELECT (r // 100)::BIGINT AS chunk, o_custkey AS upper_bound FROM (SELECT c_custkey AS o_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer WHERE NOT coalesce(c_custkey % 5 = 0, false)) WHERE r % 100 = 0")
def extract_chunks(spark, sf_dir):
    """Chunks of a planned table without the rows that it excludes, of the size that it declares."""
    _shared(spark)
    spec = TableSpec("crm.customer", "crm.customer", ("c_custkey",), (ColumnSpec("c_custkey", Logical.INT), ColumnSpec("c_name")), chunk_size=100, exclude="c_custkey % 5 = 0")
    return scans.chunk_bounds(fx.table(spark, sf_dir, "customer"), spec)


_EXTRACT = TableSpec("tpch.orders", "core.orders", ("o_orderkey",), (ColumnSpec("o_orderkey", Logical.INT), ColumnSpec("note", target_name="remark"), ColumnSpec("o_totalprice", Logical.DECIMAL, "price", scale=2), ColumnSpec("o_orderdate", Logical.DATE)))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '\\N' WHEN 3 THEN 'a, "b"' || chr(10) || 'c' ELSE o_orderpriority END AS remark, o_totalprice::DECIMAL(38,2) AS price, o_orderdate::DATE AS o_orderdate,
        77::BIGINT AS _mig_lsn, false AS _mig_deleted, (SELECT count(*) FROM orders) AS loaded FROM orders"""
)
def parts_loaded_rows(spark, sf_dir):
    """Orders written as compressed parts with a manifest, read back by it, verified, loaded and marked; ``loaded``: rows of marked parts."""
    folder = f"{_shared(spark).removeprefix('file://')}/quaymark/parts-{uuid.uuid4().hex}"
    os.makedirs(folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    k = F.col("o_orderkey") % 5
    note = F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, "\\N").when(k == 3, 'a, "b"\nc').otherwise(F.col("o_orderpriority"))
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"), F.col("o_totalprice").cast("decimal(38,2)").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("o_orderdate"))
    names = [c.name for c in _EXTRACT.columns]
    made = parts.write_parts(rows, folder, "tpch.orders", names, "o_orderkey", rows_per_part=1000, compress=True).collect()  # a row per file
    parts.write_manifest(parts.manifest(made, "tpch.orders", "core.orders", names, 77, 99), f"{folder}/orders.manifest.json")
    listed = parts.read_manifests(spark, f"file://{folder}/*.manifest.json").first().asDict(recursive=True)
    store = VersionedStore(spark, f"file://{folder}/store", buckets=4)
    parts.load(spark, store, listed, folder, _EXTRACT, "m", F.lit("2024-01-01").cast("timestamp"))
    schema = f"o_orderkey long, remark string, price decimal(38,2), o_orderdate date, {META_LSN} long, {META_DELETED} boolean"
    marked = store.table("part_state", control.SCHEMAS["part_state"]).filter("state = 'loaded'").agg(F.sum("rows")).first()[0]
    return store.table("core_orders", schema).withColumn("loaded", F.lit(marked).cast("long"))


_REASONS = [("", "x" * 30, ["a"]), ("ann", "short", ["a"]), ("ann", "ü" * 10, ["a"]), ("ann", "a perfectly good reason", ["b"]), ("ann", "a perfectly good reason", ["b", "a", "c"])]


@query("SELECT * FROM (VALUES (0, 'no author'), (1, 'reason too short'), (2, 'not acknowledged: c'), (3, 'not acknowledged: a c'), (4, NULL)) AS v(n, problem)")
def override_validation(spark, sf_dir):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(_REASONS)], "n int, who string, reason string, acknowledged array<string>")
    return rows.select("n", gate.override_problem(F.col("who"), F.col("reason"), F.col("acknowledged"), F.array(F.lit("a"), F.lit("c"))).alias("problem"))


@query(
    """WITH e AS (SELECT user_id, ts, value FROM events), o AS (SELECT user_id, max(ts) AS last, max(ts) FILTER (value > 90) AS over_at FROM e GROUP BY 1),
       s AS (SELECT e.user_id, min(ts) AS since FROM e JOIN o USING (user_id) WHERE value <= 90 AND (over_at IS NULL OR ts > over_at) GROUP BY 1)
       SELECT user_id, coalesce((epoch_us(last) - epoch_us(since)) / 1e6, 0.0) AS under_seconds FROM o LEFT JOIN s USING (user_id)"""
)
def lag_stability(spark, sf_dir):
    return gate.lag_stability(fx.table(spark, sf_dir, "events"), 90, "user_id", lag="value").select("user_id", "under_seconds")


@query(
    """WITH g AS (SELECT user_id, ts, value, sum(CASE WHEN value > 90 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS period FROM events)
       SELECT user_id, period::BIGINT AS period, count(*) AS samples, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM g WHERE value <= 90 GROUP BY 1, 2"""
)
def lag_periods(spark, sf_dir):
    return gate.lag_periods(fx.table(spark, sf_dir, "events"), 90, "user_id", lag="value")


_BOUNDS = [1, 5, 10, 30, 60, 300]


@query(f"SELECT {', '.join(f'count(*) FILTER (value <= {b}) AS le_{i}' for i, b in enumerate(_BOUNDS))}, count(value) AS total, round(sum(value), 2) AS total_value FROM events")
def metric_histogram(spark, sf_dir):
    return gate.histogram(fx.table(spark, sf_dir, "events"), "value", _BOUNDS).withColumn("total_value", F.round("total_value", 2))


# Parts

_PARTS = """p AS (SELECT (o_orderkey // 1000)::INTEGER AS index, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
    CASE WHEN index % 7 = 3 THEN 'writing' WHEN index % 3 = 0 THEN 'loaded' ELSE 'sealed' END AS state, CASE WHEN index % 11 = 4 THEN '' ELSE md5(index::VARCHAR) END AS sha256 FROM orders GROUP BY 1)"""


@query(f"WITH {_PARTS} SELECT coalesce(sum(rows) FILTER (state = 'sealed' AND sha256 <> ''), 0)::BIGINT AS sealed_rows, sum(rows)::BIGINT AS total_rows, count(*) AS parts, false AS index_repeats FROM p")
def manifest_totals(spark, sf_dir):
    return parts.manifest_totals(fx.order_parts(spark, sf_dir))


@query(f"WITH {_PARTS} SELECT count(*) AS parts_total, count(*) FILTER (state = 'loaded') AS parts_loaded FROM p")
def part_progress(spark, sf_dir):
    return parts.part_progress(fx.order_parts(spark, sf_dir))


@query(f"WITH {_PARTS} SELECT index, rows, first_key, last_key FROM p")
def part_bounds(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").withColumn("index", F.floor(F.col("o_orderkey") / 1000).cast("int"))
    return parts.part_bounds(o, "index", "o_orderkey")


@query(f"WITH {_PARTS} SELECT index, rows FROM p WHERE state = 'sealed' AND sha256 <> '' AND index % 5 <> 1")
def parts_to_load(spark, sf_dir):
    p = fx.order_parts(spark, sf_dir)
    done = p.filter("index % 5 = 1").select("index", F.lit("loaded").alias("state"))
    return parts.unloaded(p, done, ["index"]).select("index", "rows")
