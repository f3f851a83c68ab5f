"""Delivery measures and the labels derived from them."""

from pyspark.sql import functions as F

from waybill import fixed


def whole_seconds(column):
    # TIMESTAMP_NTZ has no direct cast to a number; for TIMESTAMP the first cast is dropped.
    return column.cast("timestamp").cast("long")


def elapsed_days(start, end):
    return (whole_seconds(end) - whole_seconds(start)) / F.lit(fixed.SECONDS_PER_DAY)


def breaches_sla(days, limit=fixed.SLA_DAYS):
    return days > F.lit(limit)


def known_delay(flag):
    """A shipment whose duration is unknown counts as not delayed."""
    return F.coalesce(flag, F.lit(False))


def outcome(flag):
    return F.when(flag, fixed.DELAYED_LABEL).otherwise(fixed.ON_TIME_LABEL)


def route_label(origin, destination):
    return F.concat(origin, F.lit(fixed.ROUTE_ARROW), destination)


def is_open(status):
    """Neither delivered nor cancelled; a shipment without any event is open too."""
    closed = status.isin(fixed.DELIVERED, fixed.CANCELLED)
    return ~F.coalesce(closed, F.lit(False))
