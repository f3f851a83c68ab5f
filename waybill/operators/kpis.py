"""The KPI row."""

from pyspark.sql import functions as F

from waybill.functions.measures import is_open, known_delay
from waybill.functions.rendering import dollars, grouped_integer, percent


def shipment_kpis(snapshot):
    return snapshot.agg(
        F.count("*").alias("total_shipments"),
        F.count_if(is_open(F.col("current_status"))).alias("in_transit"),
    )


def delay_kpis(performance):
    """Undelivered shipments are part of the on-time base; an empty table scores 0."""
    rows = F.count("*")
    delayed = F.count_if(known_delay(F.col("is_delayed")))
    on_time = F.when(rows > 0, F.lit(100) * (F.lit(1) - delayed / rows)).otherwise(F.lit(0.0))
    return performance.agg(delayed.alias("delayed_shipments"), on_time.alias("on_time_pct"))


def risk_kpi(routes):
    total = F.coalesce(F.sum("total_value_at_risk"), F.lit(0.0))
    return routes.agg(total.alias("value_at_risk"))


def kpis(snapshot, performance, routes):
    """All five KPIs in one row, from one pass over each table.

    The three one-row results meet through a union and a final aggregate.
    """
    parts = (
        shipment_kpis(snapshot)
        .unionByName(delay_kpis(performance), allowMissingColumns=True)
        .unionByName(risk_kpi(routes), allowMissingColumns=True)
    )
    return parts.agg(*[F.max(name).alias(name) for name in parts.columns])


def kpi_cards(kpi_row):
    return kpi_row.select(
        grouped_integer(F.col("total_shipments")).alias("total_shipments"),
        grouped_integer(F.col("in_transit")).alias("in_transit"),
        percent(F.col("on_time_pct")).alias("on_time_pct"),
        grouped_integer(F.col("delayed_shipments")).alias("delayed_shipments"),
        dollars(F.col("value_at_risk")).alias("value_at_risk"),
    )
