from pyspark.sql import functions as F

from quaymark.plans import fixtures, registry
from tests.compare import assert_equal, database
from tests.conftest import DATA


def test_every_batch_goes_through_the_merge(spark, monkeypatch):
    merged, merge = [], registry.apply.fence_merge

    def seen(target, changes, *rest, **named):
        merged.append(changes.count())
        return merge(target, changes, *rest, **named)

    monkeypatch.setattr(registry.apply, "fence_merge", seen)
    found = registry.fence_merge_batches(spark, DATA)
    assert_equal(found, database(DATA), registry.ORACLE_SQL["fence_merge_batches"])
    writes = fixtures.change_log(spark, DATA).groupBy("batch").agg(F.countDistinct("user_id").alias("n")).collect()
    assert len(merged) == 13 and sorted(merged) == sorted(r["n"] for r in writes)


def test_offsets_reach_the_end_of_the_log(spark):
    found = registry.offset_upsert_monotonic(spark, DATA)
    assert_equal(found, database(DATA), registry.ORACLE_SQL["offset_upsert_monotonic"])
    last = fixtures.change_log(spark, DATA).agg(F.max("offset")).first()[0]
    assert max(r["last_offset"] for r in found.collect()) == last
