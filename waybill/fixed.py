"""Names, vocabularies and formats that existing data and consumers rely on."""

# Feeds, tables, event vocabulary, thresholds and text formats.
SHIPMENT_TOPIC = "shipment-events"
TRACKING_TOPIC = "tracking-events"
SERVING_TABLES = {
    "shipments": "shipment_snapshot",
    "performance": "delivery_performance",
    "routes": "route_optimization",
}
PICKED_UP = "Picked Up"
DELIVERED = "Delivered"
CANCELLED = "Cancelled"
STATUS_NAMES = {
    "event_type": "current_status",
    "location": "current_location",
    "event_timestamp": "last_updated_at",
}
SLA_DAYS = 5
SECONDS_PER_DAY = 86400
SHIPPING_DATE_PATTERN = "yyyy-MM-dd"
NO_FILTER = "All"
DELAYED_LABEL = "Delayed"
ON_TIME_LABEL = "On Time"
ROUTE_ARROW = " → "
TOP_K = 10
HISTOGRAM_BINS = 20
SINK_FLUSH_RECORDS = 10
SINK_FLUSH_INTERVAL = "30 seconds"

# The serving tables name no key of their own; these are the grain of each table.
SERVING_KEYS = {
    "shipment_snapshot": ["shipment_id"],
    "delivery_performance": ["shipment_id"],
    "route_optimization": ["origin", "destination", "location"],
}
