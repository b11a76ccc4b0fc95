from quaymark.plans import registry
from tests.compare import assert_equal, database


def test_no_chunk_is_lost_whatever_its_id(spark, tmp_path):
    """Every event is in a chunk, and chunks from event 1,000,000 on have their marks."""
    events = spark.sql("SELECT id + 999000 AS event_id, id % 300 AS user_id, double(id) AS value FROM range(2500)")
    events.write.parquet(str(tmp_path / "events.parquet"))
    db = database("/nowhere")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    for name in ("window_eviction", "window_stats", "window_rejections"):
        assert_equal(registry.QUERIES[name](spark, str(tmp_path)), db, registry.ORACLE_SQL[name])
    stats = {r["chunk_id"]: r for r in registry.window_stats(spark, str(tmp_path)).collect()}
    assert sum(r["rows_buffered"] for r in stats.values()) == 2500
    # Of 300 users those of 119 events between the marks are evicted.
    assert stats["1000"]["rows_emitted"] > 0 and stats["1000"]["rows_evicted"] > 0
