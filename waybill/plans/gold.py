"""Silver to gold: delivery performance, route metrics, latest status.

Shuffle keys: every aggregation over tracking ends partitioned by shipment, which
is also the join key, so the join adds no exchange on that side.
"""

from pyspark.sql import functions as F

from waybill import fixed
from waybill.functions.measures import breaches_sla, elapsed_days
from waybill.functions.parsing import to_double
from waybill.operators.milestones import milestone_times
from waybill.operators.newest import newest_per_key
from waybill.operators.skew import spread_join
from waybill.schemas import SHIPMENT_SNAPSHOT


def performance_of(shipments, times, sla_days=fixed.SLA_DAYS):
    """Shipments with a known pick-up or delivery, their duration and SLA flag."""
    days = elapsed_days(F.col("picked_up_time"), F.col("delivered_time"))
    return (
        shipments.join(times, "shipment_id", "inner")
        .withColumn("delivery_duration_days", days)
        .withColumn("is_delayed", breaches_sla(F.col("delivery_duration_days"), sla_days))
    )


def delivery_performance(shipments, tracking, sla_days=fixed.SLA_DAYS):
    return performance_of(shipments, milestone_times(tracking), sla_days)


def events_with_shipments(shipments, tracking, heavy_share=None):
    """Every event of a known shipment with the shipment's columns.

    Only for reading single events; the metrics below do without. Where both tables come
    straight from storage, adaptive execution splits the partition of a hot shipment. Behind
    another plan it cannot: with `heavy_share`, shipments that have more than this share of all
    events are found first and dealt to several tasks.
    """
    if heavy_share:
        return spread_join(tracking, shipments, "shipment_id", heavy_share)
    return tracking.join(shipments, "shipment_id", "inner")


def event_counts(tracking):
    """Events per shipment and location, combined on the map side."""
    return tracking.groupBy("shipment_id", "location").agg(F.count("*").alias("events"))


def routes_of(shipments, counts):
    """Route metrics from event counts per shipment and location.

    A shipment counts once per event, in the number of shipments, in the value
    and in the mean weight alike. The weights `events` bring that fan-out into
    the sums, so no event is joined individually and a shipment with a huge
    number of events weighs no more than any other in the join.
    """
    shipments = shipments.select(
        "shipment_id",
        "origin",
        "destination",
        to_double(F.col("declared_value")).alias("declared_value"),
        to_double(F.col("weight_kg")).alias("weight_kg"),
    )
    events, weight = F.col("events"), F.col("weight_kg")
    weighed = F.sum(F.when(weight.isNotNull(), events))
    return (
        counts.join(shipments, "shipment_id", "inner")
        .groupBy("origin", "destination", "location")
        .agg(
            F.sum(events).alias("total_shipments"),
            F.sum(F.col("declared_value") * events).alias("total_value_at_risk"),
            (F.sum(weight * events) / weighed).alias("avg_weight_kg"),
        )
    )


def route_optimization(shipments, tracking):
    return routes_of(shipments, event_counts(tracking))


def latest_events(tracking):
    """The newest event of each shipment; among equal times the greatest event id."""
    return newest_per_key(tracking, ["shipment_id"], ["event_timestamp", "event_id"])


def status_columns(joined):
    """Event columns under the names they have as a shipment's status."""
    return joined.withColumnsRenamed(fixed.STATUS_NAMES).select(*SHIPMENT_SNAPSHOT.names)


def snapshot_of(shipments, latest):
    """Every shipment with its latest event, or nulls where it has none."""
    return status_columns(shipments.join(latest, "shipment_id", "left"))


def shipment_snapshot(shipments, tracking):
    return snapshot_of(shipments, latest_events(tracking))
