"""Counts, rankings and trends behind the charts."""

from pyspark.sql import functions as F

from waybill import fixed
from waybill.functions.measures import known_delay, outcome, route_label


def status_mix(snapshot):
    return (
        snapshot.select(F.col("current_status").alias("status"))
        .dropna()
        .groupBy("status")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "status")
    )


def delay_split(performance):
    return (
        performance.groupBy(outcome(known_delay(F.col("is_delayed"))).alias("outcome"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "outcome")
    )


def largest(df, value, label, k=fixed.TOP_K):
    """The k rows with the largest value; among equal values labels win in ascending order."""
    return df.orderBy(F.col(value).desc(), F.col(label)).limit(k)


def for_display(df, value, label):
    """Smallest first, the exact reverse of `largest`."""
    return df.orderBy(F.col(value), F.col(label).desc())


def counts_of(df, column):
    return df.select(column).dropna().groupBy(column).agg(F.count("*").alias("n"))


def top_values(df, column, k=fixed.TOP_K):
    return for_display(largest(counts_of(df, column), "n", column, k), "n", column)


def value_at_risk_by_location(routes, k=fixed.TOP_K):
    """A location whose values are all missing sums to zero."""
    sums = (
        routes.filter(F.col("location").isNotNull())
        .groupBy("location")
        .agg(F.coalesce(F.sum("total_value_at_risk"), F.lit(0.0)).alias("value_at_risk"))
    )
    return for_display(
        largest(sums, "value_at_risk", "location", k), "value_at_risk", "location"
    )


def busiest_routes(routes, k=fixed.TOP_K):
    sums = (
        routes.filter(F.col("origin").isNotNull() & F.col("destination").isNotNull())
        .groupBy("origin", "destination")
        .agg(F.sum("total_shipments").alias("total_shipments"))
        .withColumn("route", route_label(F.col("origin"), F.col("destination")))
    )
    return for_display(
        largest(sums, "total_shipments", "route", k), "total_shipments", "route"
    )


def dated(performance):
    return performance.dropna(subset=["shipping_date"])


def daily_volume(performance):
    return (
        dated(performance)
        .groupBy("shipping_date")
        .agg(F.count("*").alias("n"))
        .orderBy("shipping_date")
    )
