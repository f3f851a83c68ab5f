"""Small conveniences for reading results and plans."""

from collections import Counter
from datetime import datetime


def at(text):
    return datetime.fromisoformat(text)


def rows(df):
    """All rows as tuples, in order."""
    return [tuple(row) for row in df.collect()]


def bag(df):
    """All rows with their number of occurrences, whatever their order."""
    return Counter(rows(df))


def plan(df):
    """The physical plan as text, before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def by_key(df, key, *columns):
    picked = [tuple(row) for row in df.select(key, *columns).collect()]
    assert len(picked) == len({row[0] for row in picked}), "keys repeat"
    return {row[0]: row[1:] for row in picked}


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


SHIPMENT = (
    "shipment_id string, origin string, destination string, weight_kg double, "
    "declared_value double, shipping_date date"
)
EVENT = (
    "event_id string, shipment_id string, event_type string, event_timestamp timestamp, "
    "location string"
)
PERFORMANCE = (
    SHIPMENT + ", picked_up_time timestamp, delivered_time timestamp, "
    "delivery_duration_days double, is_delayed boolean"
)
SNAPSHOT = (
    "shipment_id string, origin string, destination string, current_status string, "
    "current_location string, last_updated_at timestamp"
)
ROUTE = (
    "origin string, destination string, location string, total_shipments long, "
    "total_value_at_risk double, avg_weight_kg double"
)


def shipments(spark, *ids, origin="A", destination="B", weight=2.0, value=10.0):
    return spark.createDataFrame(
        [(key, origin, destination, weight, value, None) for key in ids], SHIPMENT
    )


def events(spark, *tuples):
    """Events from (id, shipment, type, ISO time[, location])."""
    full = [(*item, "HUB")[:5] for item in tuples]
    return spark.createDataFrame(
        [(i, s, kind, at(when) if when else None, where) for i, s, kind, when, where in full],
        EVENT,
    )
