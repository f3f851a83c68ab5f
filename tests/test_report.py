from datetime import date, timedelta

import pytest

from tests.helpers import PERFORMANCE, ROUTE, SNAPSHOT, at, rows
from waybill.operators import kpis, ranking
from waybill.operators.histogram import histogram
from waybill.plans import report


def empty(spark):
    return (
        spark.createDataFrame([], SNAPSHOT),
        spark.createDataFrame([], PERFORMANCE),
        spark.createDataFrame([], ROUTE),
    )


def delays(spark, *flags, days=None, day=None):
    return spark.createDataFrame(
        [(str(n), "A", "B", 1.0, 1.0, day, None, None, days, flag) for n, flag in enumerate(flags)],
        PERFORMANCE,
    )


def statuses(spark, *names):
    return spark.createDataFrame(
        [(str(n), "A", "B", name, None, None) for n, name in enumerate(names)], SNAPSHOT
    )


def test_kpis_of_empty_tables(spark):
    row = kpis.kpis(*empty(spark))
    assert row.columns == [
        "total_shipments", "in_transit", "delayed_shipments", "on_time_pct", "value_at_risk"
    ]
    assert rows(row) == [(0, 0, 0, 0.0, 0.0)]
    assert rows(kpis.kpi_cards(row)) == [("0", "0", "0.0%", "0", "$0")]


def test_kpis(spark):
    snapshot = statuses(spark, "Delivered", "Cancelled", "Picked Up", None, "delivered", "")
    performance = delays(spark, True, False, None, None)
    routes = spark.createDataFrame(
        [("A", "B", "H", 1, 10.5, 1.0), ("A", "B", None, 1, None, 1.0)], ROUTE
    )
    assert rows(kpis.kpis(snapshot, performance, routes)) == [(6, 4, 1, 75.0, 10.5)]


@pytest.mark.parametrize("value", [0.5, 1.5, 2.5, 1234567.5, 999.49, 0.0])
def test_card_text_rounds_as_python_does(spark, value):
    row = spark.createDataFrame(
        [(1234567, 1000, 0, value % 100, value)],
        "total_shipments long, in_transit long, delayed_shipments long, "
        "on_time_pct double, value_at_risk double",
    )
    assert rows(kpis.kpi_cards(row)) == [
        ("1,234,567", "1,000", f"{value % 100:.1f}%", "0", f"${value:,.0f}")
    ]


@pytest.mark.parametrize("value", [12.25, 12.35, 99.95, 33.333])
def test_percent_text(spark, value):
    row = spark.createDataFrame(
        [(1, 1, 1, value, 1.0)],
        "total_shipments long, in_transit long, delayed_shipments long, "
        "on_time_pct double, value_at_risk double",
    )
    assert row.transform(kpis.kpi_cards).first().on_time_pct == f"{value:.1f}%"


def test_status_mix_leaves_out_missing_statuses(spark):
    mix = ranking.status_mix(statuses(spark, "B", "A", None, "C", "C"))
    assert rows(mix) == [("C", 2), ("A", 1), ("B", 1)]


def test_unknown_delays_count_as_on_time(spark):
    assert rows(ranking.delay_split(delays(spark, True, None, False))) == [
        ("On Time", 2), ("Delayed", 1)
    ]


def test_top_values_with_ties_at_the_last_rank(spark):
    labels = [f"L{n:02d}" for n in range(12)] + ["L11", "L11", "L10", None, None, None, None]
    frame = spark.createDataFrame([(label,) for label in labels], "origin string")
    top = rows(ranking.top_values(frame, "origin"))
    assert top == [(f"L{n:02d}", 1) for n in reversed(range(8))] + [("L10", 2), ("L11", 3)]


def test_value_at_risk_by_location(spark):
    routes = spark.createDataFrame(
        [
            ("A", "B", "H1", 1, 5.0, 1.0),
            ("C", "B", "H1", 1, 6.0, 1.0),
            ("A", "B", "H2", 1, None, 1.0),
            ("A", "B", None, 1, 99.0, 1.0),
        ],
        ROUTE,
    )
    assert rows(ranking.value_at_risk_by_location(routes)) == [("H2", 0.0), ("H1", 11.0)]


def test_busiest_routes_merge_locations(spark):
    routes = spark.createDataFrame(
        [
            ("A", "B", "H1", 2, 1.0, 1.0),
            ("A", "B", None, 3, 1.0, 1.0),
            ("B", "A", "H1", 9, 1.0, 1.0),
            (None, "A", "H1", 99, 1.0, 1.0),
            ("A", None, "H1", 99, 1.0, 1.0),
        ],
        ROUTE,
    )
    assert rows(ranking.busiest_routes(routes).select("route", "total_shipments")) == [
        ("A → B", 5), ("B → A", 9)
    ]


def test_daily_volume(spark):
    first = date(2026, 5, 1)
    frame = (
        delays(spark, True, day=first + timedelta(1))
        .union(delays(spark, None, None, day=first))
        .union(delays(spark, True))
    )
    assert rows(ranking.daily_volume(frame)) == [(first, 2), (first + timedelta(1), 1)]


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([], []),
        ([None], []),
        ([3.25, 3.25, None], [(3.0, 4.0, 2)]),
        ([-0.5], [(-1.0, 0.0, 1)]),
        ([0.0, 4.9, 5.0, 99.0], [(0.0, 5.0, 2), (5.0, 10.0, 1), (95.0, 100.0, 1)]),
        # 0 to 100 in fives would need 21 bins, so the bins are tens.
        ([0.0, 5.0, 10.0, 100.0], [(0.0, 10.0, 2), (10.0, 20.0, 1), (100.0, 110.0, 1)]),
        ([-30.0, -25.0, 1.0], [(-30.0, -28.0, 1), (-26.0, -24.0, 1), (0.0, 2.0, 1)]),
        ([0.1, 0.3, 1.5], [(0.1, 0.2, 1), (0.3, 0.4, 1), (1.5, 1.6, 1)]),
        ([0.0, 2e6], [(0.0, 200000.0, 1), (2000000.0, 2200000.0, 1)]),
    ],
)
def test_histogram(spark, values, expected):
    frame = spark.createDataFrame([(value,) for value in values], "days double")
    assert rows(histogram(frame, "days")) == expected


def test_histogram_keeps_every_value_in_at_most_twenty_bins(spark):
    frame = spark.range(5000).selectExpr("(id * 7919 % 10007) / 86400.0 * 13 - 0.7 AS days")
    bins = rows(histogram(frame.selectExpr("cast(days AS double) AS days"), "days"))
    assert len(bins) <= 20
    assert sum(n for _, _, n in bins) == 5000
    assert len({round(end - start, 9) for start, end, _ in bins}) == 1


def test_report_of_empty_tables(spark):
    names = ("shipments", "performance", "routes")
    datasets = report.report(dict(zip(names, empty(spark), strict=True)))
    filled = {name for name, df in datasets.items() if df.count()}
    assert filled == {"kpis", "kpi_cards"}


def test_status_counts_and_missing_ones_add_up(spark):
    snapshot = statuses(spark, "A", None, "B", "A", None)
    counted = sum(n for _, n in rows(ranking.status_mix(snapshot)))
    missing = snapshot.filter("current_status IS NULL").count()
    assert counted + missing == rows(kpis.shipment_kpis(snapshot))[0][0]


def test_tables_read_back_as_text(spark):
    frame = spark.createDataFrame(
        [("1", "2026-05-01T10:00:00", True), ("2", "soon", None), ("3", None, False)],
        "shipment_id string, picked_up_time string, is_delayed boolean",
    )
    read_back = report.restored("performance", frame)
    assert sorted(rows(read_back)) == [
        ("1", at("2026-05-01 10:00:00"), True), ("2", None, None), ("3", None, False)
    ]
    assert sorted(rows(report.settled(read_back.drop("picked_up_time")))) == [
        ("1", True), ("2", False), ("3", False)
    ]
