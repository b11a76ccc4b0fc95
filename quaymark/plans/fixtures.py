"""The shapes that the registered queries work on, derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.plans.spec import ColumnSpec, Logical, Protection, TableSpec

ORDERS = TableSpec(
    "tpch.orders", "tpch.orders", ("o_orderkey",),
    (
        ColumnSpec("o_orderkey", Logical.INT), ColumnSpec("o_custkey", Logical.INT), ColumnSpec("o_orderstatus"), ColumnSpec("o_totalprice", Logical.DECIMAL, scale=2),
        ColumnSpec("o_orderdate", Logical.DATE), ColumnSpec("o_orderpriority", trim_trailing_space=True),
    ),
)
CUSTOMER = TableSpec(
    "crm.customer", "crm.customer", ("c_custkey",),
    (
        ColumnSpec("c_custkey", Logical.INT, protect=Protection.TOKENIZE), ColumnSpec("c_name", target_name="name", protect=Protection.TOKENIZE),
        ColumnSpec("c_acctbal", Logical.DECIMAL, scale=2), ColumnSpec("c_mktsegment", protect=Protection.REDACT),
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; times without a zone, as events have them, are in the session's."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of 150 users: ties of ``lsn``, batches that arrive out of order, tombstones."""
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return e.select(
        F.lit("app.accounts").alias("table"), F.col("user_id"), op.alias("op"), F.floor(F.col("event_id") / 2).alias("lsn"), F.col("event_id").alias("offset"),
        (F.col("user_id") % 8).cast("int").alias("partition"), F.lit("app").alias("topic"), ((F.col("event_id") * 7919) % 13).alias("batch"), "value", "props",
    )


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as JSON messages, of which some are empty, broken or lack what is needed."""
    e = change_log(spark, sf_dir)
    image = F.struct(F.col("user_id").cast("string").alias("user_id"), F.col("value").cast("string").alias("value"))
    i = F.col("offset")
    op = F.when(i % 97 == 5, "z").otherwise(F.col("op"))
    n = F.col("lsn")
    source = F.struct(
        F.lit("postgresql").alias("connector"), F.lit("bank").alias("db"), F.when(i % 3 > 0, "app").alias("schema"), F.lit("accounts").alias("table"),
        F.when(i % 5 == 0, F.concat(F.upper(F.hex(F.floor(n / 256))), F.lit("/"), F.upper(F.hex(n % 256)))).when(i % 5 == 1, n.cast("string")).alias("lsn"),
        F.when(i % 5 == 2, n.cast("string")).alias("scn"),
        F.when(i % 5 == 3, F.concat(F.lit("mysql-bin."), F.lpad((n % 1000).cast("string"), 6, "0"))).alias("file"), F.when(i % 5 == 3, n.cast("string")).alias("pos"),
        (n + 1_700_000_000_000).cast("string").alias("ts_ms"), F.when(i % 7 == 0, "incremental").otherwise("false").alias("snapshot"),
    )
    body = F.struct(F.when(F.col("op") == "d", image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), op.alias("op"), source.alias("source"))
    text = F.when(i % 2 == 0, F.to_json(body)).otherwise(F.to_json(F.struct(body.alias("payload"))))
    value = F.when(i % 101 == 7, F.lit("")).when(i % 103 == 9, F.lit("{broken")).otherwise(text)
    key = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id")))
    return e.select("topic", "partition", "offset", key.alias("key"), value.alias("value"))


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with rows taken out, prices changed and rows added."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.when(k % 991 == 1, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    left = o.filter(k % 997 != 0).withColumn("o_totalprice", price)
    return left.unionByName(o.filter(k % 983 == 2).withColumn("o_orderkey", k + 10_000_000))


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as failures: with a marker, a SQLSTATE, an error number or a text only, at different attempts."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(i / by) % len(values) + 1).cast("int"))
    kind = i % 5
    return e.select(
        i.alias("id"), pick(["app.accounts", "app.disputes", "app.cards"], 7).alias("source_table"),
        F.when(kind == 0, pick(["transient", "permanent"], 5)).alias("marker"),
        F.when(kind == 1, pick(["40001", "23505", "08006", "22003", "99999", "42P01", "0A000", "58030"], 5)).alias("state"),
        F.when(kind == 2, pick([1213, 1062, 9999, 1452, 2013], 5)).alias("number"),
        pick(["Connection RESET by peer", "duplicate key value violates", "value too long for type", "deadlock found, data truncated", "something odd", "request timed out"], 5).alias("message"),
        (i % 14).cast("int").alias("attempts"), pick(["pending", "retrying", "quarantined", "resolved", "discarded"], 3).alias("status"),
        F.col("ts").alias("first_seen_at"), (F.col("ts") + F.expr("make_dt_interval(0, event_id % 600)")).alias("next_retry_at"),
    )


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in parts of 1000 keys, a row per part with a state by its number."""
    o = table(spark, sf_dir, "orders")
    parts = o.groupBy(F.floor(F.col("o_orderkey") / 1000).cast("int").alias("index")).agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    state = F.when(F.col("index") % 7 == 3, "writing").when(F.col("index") % 3 == 0, "loaded").otherwise("sealed")
    return parts.withColumn("state", state).withColumn("sha256", F.when(F.col("index") % 11 == 4, "").otherwise(F.md5(F.col("index").cast("string"))))
