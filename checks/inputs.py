"""The given tables seen as the two logistics feeds.

Shipments are the orders of a customer, so several rows share a shipment id and
deduplication has work to do; tracking comes from `events`.
"""

from pyspark.sql import functions as F

from waybill import fixed
from waybill.plans import gold, silver

EVENT_TYPES = {
    "signup": fixed.PICKED_UP,
    "purchase": fixed.DELIVERED,
    "error": fixed.CANCELLED,
    "view": "In Transit",
    "click": "In Transit",
}


def given(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_shipments(spark, sf_dir):
    """All text but `order_key`, which breaks ties between orders of one day. Orders without
    lines have no weight."""
    weights = (
        given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("weight"))
    )
    customers = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
    )
    nations = given(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    return (
        given(spark, sf_dir, "orders")
        .join(weights, "o_orderkey", "left")
        .join(customers, "o_custkey")
        .join(nations, "c_nationkey")
        .select(
            F.col("o_custkey").cast("string").alias("shipment_id"),
            F.col("n_name").alias("origin"),
            F.col("c_mktsegment").alias("destination"),
            F.col("weight").cast("string").alias("weight_kg"),
            F.col("o_totalprice").cast("string").alias("declared_value"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("shipping_date"),
            F.col("o_orderkey").alias("order_key"),
        )
    )


def event_type_names():
    names = F.create_map(*[F.lit(part) for pair in EVENT_TYPES.items() for part in pair])
    return names[F.col("event_type")]


def bronze_tracking(spark, sf_dir):
    customers = given(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    return given(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.lit(2) * (F.col("event_id") % customers)).cast("string").alias("shipment_id"),
        event_type_names().alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.concat(F.lit("HUB-"), (F.col("user_id") % 10).cast("string")).alias("location"),
    )


def shipments(spark, sf_dir):
    rows = silver.silver_shipments(bronze_shipments(spark, sf_dir), ["shipping_date", "order_key"])
    return rows.drop("order_key")


def tracking(spark, sf_dir):
    return silver.silver_tracking(bronze_tracking(spark, sf_dir))


def performance(spark, sf_dir):
    return gold.delivery_performance(shipments(spark, sf_dir), tracking(spark, sf_dir))


def routes(spark, sf_dir):
    return gold.route_optimization(shipments(spark, sf_dir), tracking(spark, sf_dir))


def snapshot(spark, sf_dir):
    return gold.shipment_snapshot(shipments(spark, sf_dir), tracking(spark, sf_dir))


def gold_tables(spark, sf_dir):
    silver_pair = shipments(spark, sf_dir), tracking(spark, sf_dir)
    return {
        "shipments": gold.shipment_snapshot(*silver_pair),
        "performance": gold.delivery_performance(*silver_pair),
        "routes": gold.route_optimization(*silver_pair),
    }


def rough_shipments(spark, sf_dir):
    """Orders as shipment rows that need cleaning: padded text, malformed numbers, days
    in another pattern and missing ids, spread over the rows by order status and priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("string")
    return given(spark, sf_dir, "orders").select(
        F.when(status != "P", F.col("o_custkey").cast("string")).alias("shipment_id"),
        F.concat(F.lit("  "), priority, F.lit("\t")).alias("origin"),
        F.concat(status, F.lit(" ")).alias("destination"),
        F.when(status == "F", priority).otherwise(price).alias("weight_kg"),
        price.alias("declared_value"),
        F.when(priority == "5-LOW", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("shipping_date"),
        F.col("o_orderkey").alias("order_key"),
    )


def rough_tracking(spark, sf_dir):
    """Events that need cleaning: errors lack an id, clicks carry other text for their time."""
    kind = F.col("event_type")
    return given(spark, sf_dir, "events").select(
        F.when(kind != "error", F.col("event_id").cast("string")).alias("event_id"),
        F.col("user_id").cast("string").alias("shipment_id"),
        event_type_names().alias("event_type"),
        F.when(kind == "click", F.col("props"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("event_timestamp"),
        F.concat(F.lit("HUB-"), (F.col("user_id") % 10).cast("string")).alias("location"),
    )
