"""First time of each event type, as one column per type."""

from pyspark.sql import functions as F

from waybill import fixed

COLUMNS = {fixed.PICKED_UP: "picked_up_time", fixed.DELIVERED: "delivered_time"}


def milestone_events(tracking, event_types=tuple(COLUMNS)):
    return tracking.filter(F.col("event_type").isin(*event_types))


def milestone_times(tracking):
    """One row per shipment that was picked up or delivered, with the earliest time of each.

    The value list is explicit, so no job runs to find it. `min` over timestamps
    aggregates in hash buffers on the map side; among repeated events of a type it
    settles on the earliest.
    """
    return (
        milestone_events(tracking)
        .groupBy("shipment_id")
        .pivot("event_type", list(COLUMNS))
        .agg(F.min("event_timestamp"))
        .withColumnsRenamed(COLUMNS)
    )
