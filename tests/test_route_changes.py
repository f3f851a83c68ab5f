import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag
from waybill import schemas
from waybill.layout import Layout
from waybill.plans import gold, increments, pipeline, route_changes, silver
from waybill.sources import bronze, serving


def land(spark, path, schema, number, rows):
    spark.createDataFrame(rows, schema).write.json(f"{path}/batch-q-{number:010d}")


def batches(rng):
    """Shipments and events that are new, that replace others, late or not, and null ids."""
    ids, places = [f"s{n}" for n in range(12)], ["A", "B", None]
    shipments = [
        (rng.choice(ids), rng.choice(places), rng.choice(places), rng.choice(["1.5", "2.25", "x", None]),
         rng.choice(["10.1", "0.2", None]), f"2026-05-{rng.randrange(1, 28):02d}")
        for _ in range(rng.choice([0, 3, 8]))
    ]
    events = [
        (rng.choice([None, *[f"e{n}" for n in range(60)]]), rng.choice([*ids, "orphan", None]), "In Transit",
         f"2026-05-{rng.randrange(1, 28):02d} 0{rng.randrange(10)}:00:00", rng.choice(["H1", "H2", None]))
        for _ in range(rng.choice([0, 10, 30]))
    ]
    return shipments, events


def expected_routes(spark, layout):
    shipments = silver.silver_shipments(bronze.read_bronze(spark, layout.bronze_shipments, schemas.BRONZE_SHIPMENTS))
    tracking = silver.silver_tracking(bronze.read_bronze(spark, layout.bronze_tracking, schemas.BRONZE_TRACKING))
    return rounded(gold.route_optimization(shipments, tracking))


def rounded(df):
    return bag(df.selectExpr(*df.columns[:4], "round(total_value_at_risk, 6)", "round(avg_weight_kg, 9)"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_equal_the_full_job(spark, folder, seed):
    rng = random.Random(seed)
    layout = Layout(folder("root"), incremental=True, follow_routes=True)
    for number in range(6):
        shipments, events = batches(rng)
        if number == 0:
            shipments, events = shipments or [("s1", "A", "B", "1", "2", "2026-05-01")], events or [("e", "s1", "x", "2026-05-01", "H")]
        if shipments:
            land(spark, layout.bronze_shipments, schemas.BRONZE_SHIPMENTS, number, shipments)
        if events:
            land(spark, layout.bronze_tracking, schemas.BRONZE_TRACKING, number, events)
        for step in (pipeline.clean_shipments, pipeline.clean_tracking):
            if number % 3 != 1:  # otherwise the changes wait for the next run
                step(spark, layout)
        if number % 3 != 1:
            pipeline.build_routes(spark, layout)
            found = rounded(spark.read.parquet(layout.routes))
            assert found == expected_routes(spark, layout), number
    assert route_changes.follow(spark, layout) == 0


def test_a_run_that_died_takes_up_the_same_changes(spark, folder, monkeypatch):
    layout = Layout(folder("root"), incremental=True, follow_routes=True)
    land(spark, layout.bronze_shipments, schemas.BRONZE_SHIPMENTS, 0, [("s1", "A", "B", "1", "2", "2026-05-01")])
    land(spark, layout.bronze_tracking, schemas.BRONZE_TRACKING, 0, [("e1", "s1", "x", "2026-05-01", "H")])
    pipeline.clean_shipments(spark, layout)
    for broken in (increments.serving, route_changes.serving):
        with monkeypatch.context() as patched:
            patched.setattr(broken, "_commit", lambda *args, **changes: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                pipeline.clean_tracking(spark, layout)
                pipeline.build_routes(spark, layout)
        pipeline.clean_tracking(spark, layout)
    pipeline.build_routes(spark, layout)
    assert rounded(spark.read.parquet(layout.routes)) == expected_routes(spark, layout) == {("A", "B", "H", 1, 2.0, 1.0): 1}
    # The events of a shipment follow it to its new route; the old one is gone.
    land(spark, layout.bronze_shipments, schemas.BRONZE_SHIPMENTS, 1, [("s1", "A", "C", "3", None, "2026-05-02")])
    for step in (pipeline.clean_shipments, pipeline.clean_tracking, pipeline.build_routes):
        step(spark, layout)
    assert rounded(spark.read.parquet(layout.routes)) == {("A", "C", "H", 1, None, 3.0): 1}
    assert serving.read_current(spark, layout.route_sums).count() == 2
    with pytest.raises(ValueError, match="incremental"):
        Layout("x", follow_routes=True)


def test_bronze_is_taken_apart_once(spark, folder):
    """However often a run reads what it takes in, each line of bronze is cleaned once."""
    layout = Layout(folder("root"), incremental=True, follow_routes=True)
    schema, clean, keys, newest_by = increments.SHIPMENTS
    cleaned = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        cleaned.add(1)
        return value

    def counting(df):
        return clean(df.withColumn("origin", counted("origin")))

    feed = (schema, counting, keys, newest_by)
    for number in range(2):
        rows = [(f"s{n}", "A", "B", "1", "2", f"2026-05-0{number + 1}") for n in range(5)]
        land(spark, layout.bronze_shipments, schema, number, rows)
        increments.take_in(spark, layout.shipment_folders, layout.silver_shipments, feed, changes=layout.shipment_changes)
    assert cleaned.value == 10
    assert serving.read_current(spark, layout.silver_shipments).count() == 5
