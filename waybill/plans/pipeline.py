"""The runner: bronze files to silver, gold and serving tables under one root."""

from waybill import schemas
from waybill.layout import Layout
from waybill.plans import gold, increments, route_changes, silver
from waybill.plans.serving import load_serving
from waybill.session import shuffles_sized_for
from waybill.sources import serving
from waybill.sources.bronze import read_bronze
from waybill.sources.tables import read_table, write_bucketed, write_table


def clean_shipments(spark, layout):
    if layout.incremental:
        increments.take_in_shipments(spark, layout)
        return
    with shuffles_sized_for(spark, *layout.shipment_folders, partitions=layout.buckets):
        bronze = read_bronze(spark, layout.shipment_folders, schemas.BRONZE_SHIPMENTS)
        rows = silver.silver_shipments(bronze)
        if layout.buckets:
            write_bucketed(
                rows, layout.shipments_table, layout.silver_shipments, "shipment_id", layout.buckets
            )
        else:
            write_table(rows, layout.silver_shipments)


def clean_tracking(spark, layout):
    if layout.incremental:
        increments.take_in_tracking(spark, layout)
        return
    with shuffles_sized_for(spark, *layout.tracking_folders):
        bronze = read_bronze(spark, layout.tracking_folders, schemas.BRONZE_TRACKING)
        write_table(silver.silver_tracking(bronze), layout.silver_tracking)


def silver_tables(spark, layout):
    if layout.incremental:
        tables = layout.silver_shipments, layout.silver_tracking
        return tuple(serving.read_current(spark, table) for table in tables)
    if layout.buckets:
        shipments = spark.table(layout.shipments_table)
    else:
        shipments = read_table(spark, layout.silver_shipments)
    return shipments, read_table(spark, layout.silver_tracking)


def _build(spark, layout, job, path):
    """Gold jobs read only their own columns of silver, so each scans it for itself."""
    inputs = layout.silver_shipments, layout.silver_tracking
    with shuffles_sized_for(spark, *inputs, partitions=layout.buckets):
        write_table(job(*silver_tables(spark, layout)), path)


def build_performance(spark, layout):
    _build(spark, layout, gold.delivery_performance, layout.performance)


def build_routes(spark, layout):
    if layout.follow_routes:
        route_changes.follow(spark, layout)
        sums = serving.read_current(spark, layout.route_sums)
        write_table(route_changes.routes_from(sums), layout.routes)
        return
    _build(spark, layout, gold.route_optimization, layout.routes)


def build_snapshot(spark, layout):
    _build(spark, layout, gold.shipment_snapshot, layout.snapshot)


def serve(spark, layout, partitions=None):
    with shuffles_sized_for(spark, layout.gold):
        load_serving(spark, layout.gold, layout.serving, partitions)


STEPS = [clean_shipments, clean_tracking, build_performance, build_routes, build_snapshot, serve]


def run(spark, root, **layout_options):
    """Every step writes its table, so a failed run resumes from the layer before."""
    layout = Layout(root, **layout_options)
    for step in STEPS:
        step(spark, layout)
    return layout
