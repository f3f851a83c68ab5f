"""Explicit schemas, so that no read has to scan a file to infer one."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def all_strings(names):
    return StructType([StructField(name, StringType()) for name in names])


def with_text_field(schema, name):
    return StructType([*schema.fields, StructField(name, StringType())])


BRONZE_SHIPMENTS = all_strings(
    ["shipment_id", "origin", "destination", "weight_kg", "declared_value", "shipping_date"]
)

BRONZE_TRACKING = all_strings(
    ["event_id", "shipment_id", "event_type", "event_timestamp", "location"]
)

SILVER_SHIPMENTS = StructType(
    [
        StructField("shipment_id", StringType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("weight_kg", DoubleType()),
        StructField("declared_value", DoubleType()),
        StructField("shipping_date", DateType()),
    ]
)

SILVER_TRACKING = StructType(
    [
        StructField("event_id", StringType()),
        StructField("shipment_id", StringType()),
        StructField("event_type", StringType()),
        StructField("event_timestamp", TimestampType()),
        StructField("location", StringType()),
    ]
)

DELIVERY_PERFORMANCE = StructType(
    SILVER_SHIPMENTS.fields
    + [
        StructField("picked_up_time", TimestampType()),
        StructField("delivered_time", TimestampType()),
        StructField("delivery_duration_days", DoubleType()),
        StructField("is_delayed", BooleanType()),
    ]
)

ROUTE_OPTIMIZATION = StructType(
    [
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("location", StringType()),
        StructField("total_shipments", LongType()),
        StructField("total_value_at_risk", DoubleType()),
        StructField("avg_weight_kg", DoubleType()),
    ]
)

SHIPMENT_SNAPSHOT = StructType(
    [
        StructField("shipment_id", StringType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("current_status", StringType()),
        StructField("current_location", StringType()),
        StructField("last_updated_at", TimestampType()),
    ]
)
