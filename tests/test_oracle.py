"""Every registered query against its SQL, on the smallest of the given data sets."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from checks.compare import check, connect
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def outcomes(request, spark):
    """The selected queries, a few at a time."""
    connection = connect(SF_DIR)
    selected = [
        item.callspec.params["name"]
        for item in request.session.items
        if item.function is test_query_equals_sql
    ]
    with ThreadPoolExecutor(4) as pool:
        running = {
            name: pool.submit(
                check, spark, SF_DIR, connection.cursor(), name, QUERIES[name], ORACLES[name]
            )
            for name in selected
        }
    return running


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(outcomes, name):
    assert outcomes[name].result() is None


def test_entry(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    assert frame.count() == 150
    assert frame.columns == [
        "shipment_id",
        "origin",
        "destination",
        "current_status",
        "current_location",
        "last_updated_at",
    ]
