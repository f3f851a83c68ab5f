from datetime import date

from tests.helpers import at, by_key, rows
from waybill import schemas
from waybill.functions import parsing
from waybill.plans import silver
from pyspark.sql import functions as F


def text_shipments(spark, *items):
    return spark.createDataFrame(list(items), schemas.BRONZE_SHIPMENTS)


def text_tracking(spark, *items):
    return spark.createDataFrame(list(items), schemas.BRONZE_TRACKING)


def test_malformed_values_become_null(spark):
    bronze = text_shipments(
        spark,
        ("1", "A", "B", "12.5", "abc", "2026-05-22"),
        ("2", "A", "B", "", "1e3", "2026/05/22"),
        ("3", "A", "B", None, " 7 ", "2026-13-01"),
    )
    found = by_key(
        silver.silver_shipments(bronze), "shipment_id", "weight_kg", "declared_value", "shipping_date"
    )
    assert found == {
        "1": (12.5, None, date(2026, 5, 22)),
        "2": (None, 1000.0, None),
        "3": (None, 7.0, None),
    }


def test_shipments_without_id_go_and_duplicates_keep_the_newest(spark):
    bronze = text_shipments(
        spark,
        (None, "A", "B", "1", "1", "2026-05-22"),
        ("1", "old", "B", "1", "1", "2026-05-22"),
        ("1", "new", "B", "1", "1", "2026-05-23"),
        ("1", "undated", "B", "9", "9", "bad"),
        ("", "blank", "B", "1", "1", "2026-05-22"),
    )
    assert by_key(silver.silver_shipments(bronze), "shipment_id", "origin") == {
        "1": ("new",),
        "": ("blank",),
    }


def test_ties_are_settled_by_the_other_columns(spark):
    bronze = text_shipments(
        spark,
        ("1", "A", "X", "1", "1", "2026-05-22"),
        ("1", "A", "Y", "1", "1", "2026-05-22"),
        ("1", None, "Z", "1", "1", "2026-05-22"),
    )
    for frame in (bronze, bronze.orderBy(F.desc("destination"))):
        assert by_key(silver.silver_shipments(frame), "shipment_id", "origin", "destination") == {
            "1": ("A", "Y")
        }


def test_silver_keeps_the_columns_and_types(spark):
    bronze = text_shipments(spark, ("1", "A", "B", "1", "1", "2026-05-22"))
    found = silver.silver_shipments(bronze).schema
    assert [(f.name, f.dataType) for f in found] == [
        (f.name, f.dataType) for f in schemas.SILVER_SHIPMENTS
    ]
    track = text_tracking(spark, ("1", "1", "Delivered", "2026-05-22 10:00:00", "H"))
    found = silver.silver_tracking(track).schema
    assert [(f.name, f.dataType) for f in found] == [
        (f.name, f.dataType) for f in schemas.SILVER_TRACKING
    ]


def test_events_without_a_time_go_and_null_ids_are_one_event(spark):
    bronze = text_tracking(
        spark,
        ("e1", "1", "Delivered", "2026-05-22 10:00:00", "H"),
        ("e1", "1", "Delivered", "2026-05-22 11:00:00", "H"),
        ("e2", "1", "Delivered", "yesterday", "H"),
        ("e3", "1", "Delivered", None, "H"),
        (None, "1", "Delivered", "2026-05-20 10:00:00", "H1"),
        (None, "2", "Delivered", "2026-05-21 10:00:00", "H2"),
    )
    assert by_key(silver.silver_tracking(bronze), "event_id", "event_timestamp", "location") == {
        "e1": (at("2026-05-22 11:00:00"), "H"),
        None: (at("2026-05-21 10:00:00"), "H2"),
    }


def test_dedup_twice_is_dedup_once(spark):
    bronze = text_tracking(
        spark,
        *[(f"e{n % 7}", str(n), "Delivered", f"2026-05-{n % 20 + 1:02d}", "H") for n in range(60)],
    )
    once = silver.silver_tracking(bronze)
    text = once.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    assert sorted(rows(silver.silver_tracking(text))) == sorted(rows(once))


def test_strip_removes_every_kind_of_white_space(spark):
    texts = ["  a b ", "\t x　\n", " ", "", None, "plain", "\x1fodd\x85"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    found = [row[0] for row in frame.select(parsing.stripped(F.col("text"))).collect()]
    assert found == [None if text is None else text.strip() for text in texts]


def test_columns_with_odd_names_can_be_addressed(spark):
    frame = spark.createDataFrame([("x",)], ["a.b `c"])
    assert rows(frame.select(parsing.quoted("a.b `c"))) == [("x",)]
