"""Gold to serving: a keyed load of the three gold tables."""

from waybill import fixed
from waybill.sources.serving import upsert
from waybill.sources.tables import read_table


# The columns that the report's slicers filter on; all three tables have them.
SLICER_ORDER = ("origin", "destination")


def load_serving(spark, gold_root, serving_root, partitions=None):
    """Gold tables have one row per key by the way they are made, so no load reduces them."""
    for table, keys in fixed.SERVING_KEYS.items():
        rows = read_table(spark, f"{gold_root.rstrip('/')}/{table}")
        target = f"{serving_root.rstrip('/')}/{table}"
        upsert(spark, rows, target, keys, partitions, sort_by=SLICER_ORDER, unique=True)
