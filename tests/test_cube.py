import random
from datetime import date, datetime, timedelta

import pytest

from tests.helpers import PERFORMANCE, ROUTE, SNAPSHOT, plan, rows
from waybill.operators.slicers import Selection, slicer_values
from waybill.plans import cube, report


def random_tables(spark, seed, n=400):
    """Gold tables with nulls everywhere, durations of several sizes, and cells of one duration."""
    rng = random.Random(seed)
    places, start = ["A", "B", "C", None], datetime(2026, 5, 1)
    snapshot, performance, routes = [], [], []
    for k in range(n):
        origin, destination = rng.choice(places), rng.choice(places)
        status = rng.choice(["Picked Up", "Delivered", "Cancelled", "In Transit", None])
        snapshot.append((f"s{k}", origin, destination, status, "H", start))
        scale = {"A": 0.001, "B": 3.0, "C": 400.0, None: 1.0}[origin]
        days = None if rng.random() < 0.2 else 2.0 if destination == "C" else rng.choice([0.0, -1.5, rng.uniform(-1, 9)]) * scale
        day = rng.choice([None, date(2026, 5, 1) + timedelta(rng.randrange(5))])
        performance.append((f"s{k}", origin, destination, 1.0, 1.0, day, None, None, days, None if days is None else days > 5))
        value = rng.choice([None, 0.5, rng.uniform(0, 99)])
        routes.append((origin, destination, rng.choice(["H1", "H2", None]), rng.randrange(1, 9), value, None))
    return {
        "shipments": spark.createDataFrame(snapshot, SNAPSHOT),
        "performance": spark.createDataFrame(performance, PERFORMANCE),
        "routes": spark.createDataFrame(routes, ROUTE),
    }


def near(found, expected):
    """Sums of doubles depend on their order."""
    assert len(found) == len(expected)
    for one, other in zip(found, expected, strict=True):
        assert one == tuple(pytest.approx(x, rel=1e-12) if isinstance(x, float) else x for x in other)


SELECTIONS = [
    Selection(),
    Selection(origin="A"),
    Selection(origin="B", destination="C"),
    Selection(destination="B", delay="Delayed"),
    Selection(delay="On Time"),
    Selection(origin="nowhere"),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_the_cube_answers_as_the_tables_do(spark, folder, seed):
    tables = random_tables(spark, seed)
    cube.cube_of(tables).write.parquet(folder("cube"))
    held = spark.read.parquet(folder("cube"))
    for selection in SELECTIONS:
        expected = report.report(tables, selection)
        found = cube.report_from_cube(held, selection, tables)
        assert found.keys() == expected.keys()
        for name, df in expected.items():
            assert found[name].columns == df.columns, name
            assert dict(found[name].dtypes) == dict(df.dtypes), name
            near(rows(found[name]), rows(df))
    for name, values in cube.slicer_lists(held).items():
        assert rows(values) == rows(slicer_values(name, tables["shipments"], tables["performance"]))


def test_an_empty_cube(spark):
    empty = {name: df.limit(0) for name, df in random_tables(spark, 3, 5).items()}
    found = cube.report_from_cube(cube.cube_of(empty))
    assert rows(found["kpis"]) == [(0, 0, 0, 0.0, 0.0)]
    assert all(rows(df) == [] for name, df in found.items() if not name.startswith("kpi"))


def test_a_report_reads_the_cube_alone(spark, folder):
    tables = random_tables(spark, 4)
    cube.cube_of(tables).write.parquet(folder("cube"))
    held = spark.read.parquet(folder("cube"))
    for name, df in cube.report_from_cube(held, Selection(origin="A")).items():
        text = plan(df)
        assert "FileScan" in text and "LocalTableScan" not in text.replace("LocalTableScan <empty>", ""), name
        assert "PushedFilters: [" in text and "EqualTo(origin,A)" in text, name
