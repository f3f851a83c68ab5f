"""The dashboard's data: KPIs, chart datasets, filtered tables, slicer values."""

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from waybill.functions.measures import known_delay
from waybill.functions.parsing import to_instant
from waybill.operators import ranking
from waybill.operators.histogram import histogram
from waybill.operators.kpis import kpi_cards, kpis
from waybill.operators.slicers import Selection, narrow_all, slicer_values
from waybill.sources.serving import fetch_all

INSTANT_COLUMNS = {
    "shipments": ["last_updated_at"],
    "performance": ["picked_up_time", "delivered_time", "shipping_date"],
    "routes": [],
}


def restored(name, df):
    """A table with its instants parsed where they came as text."""
    for column in INSTANT_COLUMNS[name]:
        if column in df.columns and isinstance(df.schema[column].dataType, StringType):
            df = df.withColumn(column, to_instant(F.col(column)))
    return df


def settled(df):
    """A table for display, where an unknown delay is none.

    The datasets and slicers treat unknown delays by themselves. Settling them before
    the slicers would keep those from the scan.
    """
    if "is_delayed" in df.columns:
        df = df.withColumn("is_delayed", known_delay(F.col("is_delayed")))
    return df


def report(tables, selection=Selection()):
    """One DataFrame per dataset, all narrowed by the slicers.

    Every dataset reads only its own columns of its table and those that the slicers
    test, so separate passes over columnar files cost little more than a fused one.
    """
    visible = narrow_all(tables, selection)
    shipments, performance, routes = (
        visible["shipments"],
        visible["performance"],
        visible["routes"],
    )
    row = kpis(shipments, performance, routes)
    return {
        "kpis": row,
        "kpi_cards": kpi_cards(row),
        "status_mix": ranking.status_mix(shipments),
        "delay_split": ranking.delay_split(performance),
        "top_origins": ranking.top_values(performance, "origin"),
        "top_destinations": ranking.top_values(performance, "destination"),
        "duration_histogram": histogram(performance, "delivery_duration_days"),
        "value_at_risk_by_location": ranking.value_at_risk_by_location(routes),
        "daily_volume": ranking.daily_volume(performance),
        "busiest_routes": ranking.busiest_routes(routes),
        **{name: settled(df) for name, df in visible.items()},
    }


# Label and value column of each chart dataset, for the long form.
CHARTS = {
    "status_mix": ("status", "n"),
    "delay_split": ("outcome", "n"),
    "top_origins": ("origin", "n"),
    "top_destinations": ("destination", "n"),
    "duration_histogram": ("bin_start", "n"),
    "value_at_risk_by_location": ("location", "value_at_risk"),
    "daily_volume": ("shipping_date", "n"),
    "busiest_routes": ("route", "total_shipments"),
}


def long_form(datasets):
    """KPIs and charts of a report as rows (dataset, label, value)."""
    row = datasets["kpis"]
    parts = [
        row.select(F.inline(F.array(*[
            F.struct(
                F.lit("kpis").alias("dataset"),
                F.lit(name).alias("label"),
                F.col(name).cast("double").alias("value"),
            )
            for name in row.columns
        ])))
    ]
    for dataset, (label, value) in CHARTS.items():
        parts.append(
            datasets[dataset].select(
                F.lit(dataset).alias("dataset"),
                F.col(label).cast("string").alias("label"),
                F.col(value).cast("double").alias("value"),
            )
        )
    return reduce(lambda left, right: left.unionByName(right), parts)


def dashboard(tables):
    """The unfiltered report together with the values the place slicers offer.

    A search within a selection is `search(report(tables, selection)[name], query)`.
    """
    tables = {name: restored(name, df) for name, df in tables.items()}
    sources = (tables["shipments"], tables["performance"])
    return {
        "tables": tables,
        "report": report(tables),
        "origins": slicer_values("origin", *sources),
        "destinations": slicer_values("destination", *sources),
    }


@contextmanager
def kept_dashboard(tables):
    """`dashboard` over tables that executors hold for the length of a block, spilling to
    their disks, for a session that goes on to other selections."""
    held = {name: restored(name, df).persist() for name, df in tables.items()}
    try:
        yield dashboard(held)
    finally:
        for df in held.values():
            df.unpersist()


def load_dashboard(spark, serving_root):
    return dashboard(fetch_all(spark, serving_root))
