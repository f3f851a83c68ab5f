"""Bronze to silver: typed values, required fields, one row per key."""

from pyspark.sql import functions as F

from waybill.functions.parsing import to_day, to_double, to_instant
from waybill.operators.newest import newest_per_key


def typed_shipments(bronze):
    return bronze.withColumns(
        {
            "weight_kg": to_double(F.col("weight_kg")),
            "declared_value": to_double(F.col("declared_value")),
            "shipping_date": to_day(F.col("shipping_date")),
        }
    )


def typed_tracking(bronze):
    return bronze.withColumn("event_timestamp", to_instant(F.col("event_timestamp")))


def known_shipments(bronze):
    return typed_shipments(bronze).filter(F.col("shipment_id").isNotNull())


def dated_tracking(bronze):
    return typed_tracking(bronze).filter(F.col("event_timestamp").isNotNull())


def silver_shipments(bronze, newest_by=("shipping_date",)):
    """Of several rows for a shipment the one with the latest shipping date stays."""
    return newest_per_key(known_shipments(bronze), ["shipment_id"], newest_by)


def silver_tracking(bronze, newest_by=("event_timestamp",)):
    """All events without an id count as one event, of which the latest stays."""
    return newest_per_key(dated_tracking(bronze), ["event_id"], newest_by)
