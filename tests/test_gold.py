import pytest

from tests.helpers import at, by_key, events, rows, shipments
from waybill.operators import newest
from waybill.plans import gold


def durations(spark, *tuples, **options):
    keys = {item[1] for item in tuples}
    frame = gold.delivery_performance(shipments(spark, *keys), events(spark, *tuples), **options)
    return by_key(frame, "shipment_id", "delivery_duration_days", "is_delayed")


def test_duration_and_delay_flag(spark):
    assert durations(
        spark,
        ("1", "five", "Picked Up", "2026-05-01 00:00:00"),
        ("2", "five", "Delivered", "2026-05-06 00:00:00"),
        ("3", "over", "Picked Up", "2026-05-01 00:00:00"),
        ("4", "over", "Delivered", "2026-05-06 00:00:01"),
        ("5", "back", "Picked Up", "2026-05-02 00:00:00"),
        ("6", "back", "Delivered", "2026-05-01 00:00:00"),
        ("7", "open", "Picked Up", "2026-05-01 00:00:00"),
        ("8", "odd", "Delivered", "2026-05-01 00:00:00"),
        ("9", "seen", "In Transit", "2026-05-01 00:00:00"),
    ) == {
        "five": (5.0, False),
        "over": (5 + 1 / 86400, True),
        "back": (-1.0, False),
        "open": (None, None),
        "odd": (None, None),
    }


def test_fractions_of_seconds_are_cut_off(spark):
    assert durations(
        spark,
        ("1", "a", "Picked Up", "2026-05-01 00:00:00.900000"),
        ("2", "a", "Delivered", "2026-05-01 00:00:01.100000"),
        ("3", "b", "Picked Up", "2026-05-01 00:00:00.000001"),
        ("4", "b", "Delivered", "2026-05-01 00:00:00.999999"),
        ("5", "c", "Picked Up", "1969-12-31 23:59:58.500000"),
        ("6", "c", "Delivered", "1970-01-01 00:00:01.500000"),
    ) == {"a": (1 / 86400, False), "b": (0.0, False), "c": (3 / 86400, False)}


def test_sla_limit_is_a_parameter(spark):
    pair = (
        ("1", "a", "Picked Up", "2026-05-01 00:00:00"),
        ("2", "a", "Delivered", "2026-05-03 00:00:00"),
    )
    assert durations(spark, *pair)["a"][1] is False
    assert durations(spark, *pair, sla_days=1)["a"][1] is True


def test_repeated_milestones_count_from_the_earliest(spark):
    frame = gold.delivery_performance(
        shipments(spark, "a"),
        events(
            spark,
            ("1", "a", "Picked Up", "2026-05-02 00:00:00"),
            ("2", "a", "Picked Up", "2026-05-01 00:00:00"),
            ("3", "a", "Delivered", "2026-05-09 00:00:00"),
            ("4", "a", "Delivered", "2026-05-04 00:00:00"),
        ),
    )
    assert by_key(frame, "shipment_id", "picked_up_time", "delivered_time") == {
        "a": (at("2026-05-01 00:00:00"), at("2026-05-04 00:00:00"))
    }


def test_columns_of_the_performance_table(spark):
    frame = gold.delivery_performance(shipments(spark, "a"), events(spark))
    assert frame.columns == [
        "shipment_id",
        "origin",
        "destination",
        "weight_kg",
        "declared_value",
        "shipping_date",
        "picked_up_time",
        "delivered_time",
        "delivery_duration_days",
        "is_delayed",
    ]


def test_routes_count_a_shipment_once_per_event(spark):
    frame = gold.route_optimization(
        shipments(spark, "a", weight=3.0, value=100.0).union(
            shipments(spark, "b", weight=None, value=None)
        ),
        events(
            spark,
            *[(str(n), "a", "In Transit", "2026-05-01 00:00:00", "H1") for n in range(3)],
            ("3", "b", "In Transit", "2026-05-01 00:00:00", "H1"),
            ("4", "b", "In Transit", "2026-05-01 00:00:00", "H2"),
            ("5", "orphan", "In Transit", "2026-05-01 00:00:00", "H1"),
            ("6", None, "In Transit", "2026-05-01 00:00:00", "H1"),
            ("7", "a", "In Transit", "2026-05-01 00:00:00", None),
        ),
    )
    assert sorted(rows(frame), key=str) == [
        ("A", "B", "H1", 4, 300.0, 3.0),
        ("A", "B", "H2", 1, None, None),
        ("A", "B", None, 1, 100.0, 3.0),
    ]


def test_mean_weight_is_weighed_by_events(spark):
    frame = gold.route_optimization(
        shipments(spark, "a", weight=1.0).union(shipments(spark, "b", weight=4.0)),
        events(
            spark,
            ("1", "a", "x", "2026-05-01 00:00:00"),
            ("2", "a", "x", "2026-05-01 00:00:00"),
            ("3", "b", "x", "2026-05-01 00:00:00"),
        ),
    )
    assert rows(frame) == [("A", "B", "HUB", 3, 30.0, 2.0)]


def test_snapshot_shows_the_latest_event_of_every_shipment(spark):
    frame = gold.shipment_snapshot(
        shipments(spark, "a", "b"),
        events(
            spark,
            ("1", "a", "Picked Up", "2026-05-01 00:00:00", "H1"),
            ("3", "a", "Delivered", "2026-05-03 00:00:00", "H3"),
            ("2", "a", "In Transit", "2026-05-02 00:00:00", "H2"),
            ("4", "orphan", "In Transit", "2026-05-02 00:00:00", "H2"),
            ("5", None, "In Transit", "2026-05-02 00:00:00", "H2"),
        ),
    )
    assert sorted(rows(frame)) == [
        ("a", "A", "B", "Delivered", "H3", at("2026-05-03 00:00:00")),
        ("b", "A", "B", None, None, None),
    ]


def test_equal_times_are_settled_by_event_id(spark):
    twins = events(
        spark,
        ("1", "a", "Picked Up", "2026-05-01 00:00:00", "H9"),
        ("2", "a", "Picked Up", "2026-05-01 00:00:00", "H1"),
    )
    assert by_key(gold.latest_events(twins), "shipment_id", "event_id") == {"a": ("2",)}


@pytest.mark.parametrize("keys", [["shipment_id"], ["location"], ["shipment_id", "location"]])
def test_both_forms_of_newest_agree(spark, keys):
    frame = events(
        spark,
        *[
            (str(n), f"s{n % 5}" if n % 6 else None, "x", f"2026-05-{n % 28 + 1:02d}", f"H{n % 3}")
            for n in range(80)
        ],
    )
    order = ["event_timestamp", "event_id"]
    grouped = newest.newest_per_key(frame, keys, order)
    ranked = newest.first_ranked(frame, keys, order)
    assert grouped.columns == frame.columns == ranked.columns
    assert sorted(rows(grouped), key=str) == sorted(rows(ranked), key=str)
