from datetime import date

import pytest

from tests.helpers import PERFORMANCE, at, by_key, rows
from waybill.operators.slicers import Selection, narrow, narrow_all, search, slicer_values


@pytest.fixture(scope="module")
def performance(spark):
    when = at("2026-05-02 10:00:00")
    return spark.createDataFrame(
        [
            ("1", "Oslo", "Rome", 1.5, 10.0, date(2026, 5, 1), when, when, 0.0, False),
            ("2", "Oslo", "Bern", 2.5, 20.0, date(2026, 5, 2), when, when, 9.0, True),
            ("3", "Bern", "Rome", None, 30.0, None, when, None, None, None),
            ("4", None, "Rome", 4.5, 40.0, date(2026, 5, 3), None, None, None, None),
        ],
        PERFORMANCE,
    )


def ids(df):
    return sorted(row[0] for row in df.select("shipment_id").collect())


@pytest.mark.parametrize(
    ("selection", "expected"),
    [
        (Selection(), ["1", "2", "3", "4"]),
        (Selection("", None, ""), ["1", "2", "3", "4"]),
        (Selection(origin="Oslo"), ["1", "2"]),
        (Selection(destination="Rome"), ["1", "3", "4"]),
        (Selection(delay="Delayed"), ["2"]),
        (Selection(delay="On Time"), ["1", "3", "4"]),
        (Selection("Oslo", "Rome", "On Time"), ["1"]),
        (Selection("Oslo", "Rome", "Delayed"), []),
        (Selection(origin="Nowhere"), []),
    ],
)
def test_narrow(performance, selection, expected):
    assert ids(narrow(performance, selection)) == expected


def test_a_slicer_whose_column_is_missing_is_skipped(performance):
    trimmed = performance.drop("destination", "is_delayed")
    assert ids(narrow(trimmed, Selection("Oslo", "Rome", "Delayed"))) == ["1", "2"]


def test_the_delay_slicer_reaches_only_performance(performance):
    tables = {"shipments": performance, "performance": performance, "routes": performance}
    visible = narrow_all(tables, Selection(destination="Rome", delay="Delayed"))
    assert {name: ids(df) for name, df in visible.items()} == {
        "shipments": ["1", "3", "4"],
        "performance": [],
        "routes": ["1", "3", "4"],
    }


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        (None, ["1", "2", "3", "4"]),
        ("   ", ["1", "2", "3", "4"]),
        ("oSLo", ["1", "2"]),
        ("  bern ", ["2", "3"]),
        ("^r.me$", ["1", "3", "4"]),
        ("2026-05-03", ["4"]),
        ("10:00", ["1", "2", "3"]),
        ("4\\.5", ["4"]),
        ("true", ["2"]),
        ("null|none", []),
        ("Oslo|Bern", ["1", "2", "3"]),
    ],
)
def test_search(performance, query, expected):
    assert ids(search(performance, query)) == expected


def test_literal_search_takes_every_character_as_itself(spark):
    frame = spark.createDataFrame(
        [("1", "a.b"), ("2", "axb"), ("3", "(A.B)+ \\E [x]"), ("4", None)], "shipment_id string, t string"
    )
    assert ids(search(frame, "a.b", regex=False)) == ["1", "3"]
    assert ids(search(frame, "(a.b)+ \\e [X]", regex=False)) == ["3"]
    assert ids(search(frame, "a.b")) == ["1", "2", "3"]


def test_search_ignores_case_beyond_ascii(spark):
    frame = spark.createDataFrame([("1", "ÅRHUS"), ("2", "Oslo")], "shipment_id string, t string")
    assert ids(search(frame, "århus")) == ["1"]


def test_a_broken_pattern_is_an_error(performance):
    with pytest.raises(ValueError, match="regular expression"):
        search(performance, "(")


def test_slicer_values_merge_tables_and_leave_out_nulls(spark, performance):
    other = spark.createDataFrame([("Zug",), (None,), ("Oslo",), ("ähtäri",)], "origin string")
    assert rows(slicer_values("origin", performance, other)) == [
        ("Bern",), ("Oslo",), ("Zug",), ("ähtäri",)
    ]
    numbers = spark.createDataFrame([(10,), (9,)], "origin int")
    assert rows(slicer_values("origin", numbers)) == [("10",), ("9",)]
    assert rows(slicer_values("origin", performance.drop("origin"), other)) == [
        ("Oslo",), ("Zug",), ("ähtäri",)
    ]
    with pytest.raises(ValueError, match="nothing"):
        slicer_values("nothing", performance)


def test_filters_commute(performance):
    one = narrow(narrow(performance, Selection(origin="Oslo")), Selection(delay="On Time"))
    two = narrow(narrow(performance, Selection(delay="On Time")), Selection(origin="Oslo"))
    assert by_key(one, "shipment_id") == by_key(two, "shipment_id") == {"1": ()}
