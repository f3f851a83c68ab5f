from statistics import median

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, events, rows, shipments
from waybill.operators.newest import newest_per_key
from waybill.operators.skew import heavy_keys, spread_join
from waybill.plans import gold


@pytest.fixture
def many(spark):
    """48,000 rows behind an aggregate, a third of them with one key, and a row per key."""
    rows_ = spark.range(48_000).selectExpr("id", "IF(id % 3 = 0, 'hot', string(id % 4001)) AS k")
    others = rows_.select("k").distinct().withColumn("v", F.length("k"))
    return newest_per_key(rows_, ["id"]), others


def test_no_task_has_much_more_than_the_others(spark, many):
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("false", "-1", "16"), strict=True):
        spark.conf.set(name, value)
    try:
        sizes = {}
        for name, joined in (("plain", many[0].join(many[1], "k")), ("spread", spread_join(*many, "k", 1 / 256))):
            found = joined.groupBy(F.spark_partition_id().alias("task")).count()
            sizes[name] = [row["count"] for row in found.collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert max(sizes["plain"]) > 5 * median(sizes["plain"])
    assert max(sizes["spread"]) < 2 * median(sizes["spread"])
    assert sum(sizes["spread"]) == 48_000


def test_heavy_keys_are_few(many):
    assert rows(heavy_keys(many[0], "k", 1 / 256)) == [("hot", 86)]
    assert heavy_keys(many[0], "k", 1e-9).count() <= 4002


def test_the_join_is_the_same(spark, many):
    assert bag(spread_join(*many, "k", 1 / 256)) == bag(many[0].join(many[1], "k"))
    shipped = shipments(spark, "a", "b")
    tracked = events(
        spark, ("1", "a", "x", None), ("2", "a", "x", None), ("2", "a", "x", None), ("3", None, "x", None), ("4", "c", "x", None)
    )
    for share in (0.1, 0.9):
        assert bag(gold.events_with_shipments(shipped, tracked, share)) == bag(gold.events_with_shipments(shipped, tracked))
    assert gold.events_with_shipments(shipped, tracked.limit(0), 0.1).count() == 0
