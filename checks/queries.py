"""One query per inventory id, each over the whole of its tables."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from checks import inputs
from waybill import fixed, schemas
from waybill.functions import measures, parsing, rendering
from waybill.functions.parsing import quoted
from waybill.layout import Layout
from waybill.operators import kpis as kpi
from waybill.operators import milestones, newest, ranking, slicers
from waybill.operators.histogram import histogram
from waybill.operators.slicers import Selection
from waybill.plans import cube, gold, pipeline, report, silver
from waybill.session import work_dir
from waybill.sources import bronze, csv_feed, serving, tables, topic
from waybill.streaming import feeds

QUERIES = {}


def comparable(df):
    """Instants without a zone, as SQL's TIMESTAMP has none."""
    names = [field.name for field in df.schema.fields if isinstance(field.dataType, TimestampType)]
    return df.withColumns({name: quoted(name).cast("timestamp_ntz") for name in names})


def query(name):
    def register(build):
        def run(spark, sf_dir):
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def in_cents(df, column):
    """Sums of amounts to the cent: floating-point sums depend on the order of their terms."""
    return df.withColumn(column, F.round(column, 2))


def wide(bundle):
    """Several tables as one, with the name of each row's table."""
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in bundle.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)


def drained(stream_query):
    stream_query.awaitTermination()
    if stream_query.exception():
        raise stream_query.exception()


def text_tracking(spark, sf_dir):
    return inputs.bronze_tracking(spark, sf_dir)


def text_shipments(spark, sf_dir):
    return inputs.bronze_shipments(spark, sf_dir).drop("order_key")


def message_folder(spark, sf_dir, path):
    topic.publish(text_tracking(spark, sf_dir), fmt="text", path=path)


def staged_silver(spark, sf_dir, label):
    layout = Layout(work_dir(spark, label))
    tables.write_table(inputs.shipments(spark, sf_dir), layout.silver_shipments)
    tables.write_table(inputs.tracking(spark, sf_dir), layout.silver_tracking)
    return layout


def staged_gold(spark, sf_dir, label):
    layout = staged_silver(spark, sf_dir, label)
    for step in (pipeline.build_performance, pipeline.build_routes, pipeline.build_snapshot):
        step(spark, layout)
    return layout


def staged_serving(spark, sf_dir, label):
    layout = staged_gold(spark, sf_dir, label)
    pipeline.serve(spark, layout)
    return layout


# Sources, sinks, exchange


def csv_copy(spark, sf_dir, label):
    path = work_dir(spark, label)
    rough = inputs.rough_shipments(spark, sf_dir).drop("order_key")
    padded = rough.select(*[quoted(name).alias(f" {name} ") for name in rough.columns])
    padded.write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("S01_csv_scan")
def s01(spark, sf_dir):
    return csv_feed.read_csv_feed(spark, csv_copy(spark, sf_dir, "s01"))


def mixed_copy(spark, sf_dir, path, parts=("even", "odd")):
    """Files of two column orders, of which one has padded names and one more column."""
    rough = inputs.rough_shipments(spark, sf_dir)
    even = rough.filter("order_key % 2 = 0").drop("order_key")
    odd = rough.filter("order_key % 2 = 1").select(
        *[quoted(name).alias(f" {name}") for name in reversed(rough.columns)]
    )
    for part in parts:
        {"even": even, "odd": odd}[part].write.mode("append").option("header", True).option(
            "escape", '"'
        ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@query("S01_mixed_headers")
def s01_mixed(spark, sf_dir):
    path = work_dir(spark, "s01-mixed")
    mixed_copy(spark, sf_dir, path)
    return csv_feed.read_csv_feed(spark, path)


@query("S01_streamed_mixed_headers")
def s01_streamed(spark, sf_dir):
    """The files of the second header come after a restart; all rows arrive once, by name."""
    path = work_dir(spark, "s01-streamed")
    for part in ("even", "odd"):
        mixed_copy(spark, sf_dir, f"{path}/feed", [part])
        for _ in range(2):
            drained(
                feeds.feed_to_topic(
                    spark, f"{path}/feed", f"{path}/checkpoint", fmt="text", path=f"{path}/topic"
                )
            )
    schema = schemas.all_strings([*schemas.BRONZE_SHIPMENTS.names, "order_key"])
    return topic.read_topic(spark, schema, fmt="text", path=f"{path}/topic")


@query("S02_publish_json_messages")
def s02(spark, sf_dir):
    path = work_dir(spark, "s02")
    message_folder(spark, sf_dir, path)
    return spark.read.text(path)


@query("S03_consume_topic")
def s03(spark, sf_dir):
    path = work_dir(spark, "s03")
    message_folder(spark, sf_dir, f"{path}/topic")
    stream = topic.subscribe(
        spark, schemas.BRONZE_TRACKING, fmt="text", path=f"{path}/topic"
    )
    drained(
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/received")
    )
    return spark.read.parquet(f"{path}/received")


@query("S04_append_bronze_json")
def s04(spark, sf_dir):
    path = work_dir(spark, "s04")
    message_folder(spark, sf_dir, f"{path}/topic")
    stream = topic.follow(spark, fmt="text", path=f"{path}/topic")
    drained(bronze.append_bronze(stream, f"{path}/bronze", f"{path}/checkpoint"))
    return bronze.read_bronze(spark, f"{path}/bronze", schemas.BRONZE_TRACKING)


@query("S04_packed_bronze")
def s04_packed(spark, sf_dir):
    """A folder per micro-batch, packed into few; the topic's next batches land next to them, and
    are packed with them in turn."""
    path = work_dir(spark, "s04-packed")
    rows = text_tracking(spark, sf_dir)
    for part in (rows.filter(F.col("event_type") == fixed.CANCELLED), rows.filter(F.col("event_type") != fixed.CANCELLED)):
        topic.publish(part.repartition(3), fmt="text", path=f"{path}/topic")
        stream = topic.follow(spark, fmt="text", path=f"{path}/topic", maxFilesPerTrigger=1)
        drained(bronze.append_bronze(stream, f"{path}/bronze", f"{path}/checkpoint"))
        bronze.pack(spark, f"{path}/bronze")
    return bronze.read_bronze(spark, f"{path}/bronze", schemas.BRONZE_TRACKING)


@query("S05_declared_bronze_sink")
def s05(spark, sf_dir):
    """Every record, and whether its file keeps to the bound."""
    bound = 1_000
    path = work_dir(spark, "s05")
    message_folder(spark, sf_dir, f"{path}/topic")
    stream = topic.follow(spark, fmt="text", path=f"{path}/topic")
    drained(bronze.declared_sink(stream, f"{path}/bronze", f"{path}/checkpoint", bound))
    lines = spark.read.option("recursiveFileLookup", True).text(f"{path}/bronze")
    files = lines.groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    most = files.agg(F.max("n")).first()[0]
    records = bronze.read_bronze(spark, f"{path}/bronze", schemas.BRONZE_TRACKING)
    return records.withColumn("within_bound", F.lit(most <= bound))


@query("S05_counted_flush")
def s05_counted(spark, sf_dir):
    """Every record, and how many files the flushes of a thousand records have filled; what is
    left at the end has waited long enough. A micro-batch a file of the topic."""
    bound, path = 1_000, work_dir(spark, "s05-counted")
    message_folder(spark, sf_dir, f"{path}/topic")
    messages = topic.follow(spark, fmt="text", path=f"{path}/topic", maxFilesPerTrigger=1)
    for wait in (1 << 40, 0):
        def land(batch, batch_id, wait=wait):
            bronze.flush(batch, batch_id, f"{path}/bronze", bound, wait)

        writer = messages.writeStream.foreachBatch(land).option("checkpointLocation", f"{path}/checkpoint")
        drained(writer.trigger(availableNow=True).start())
        spark.range(1).selectExpr("' ' AS value").write.mode("append").text(f"{path}/topic")
    lines = spark.read.option("recursiveFileLookup", True).text(f"{path}/bronze")
    files = lines.groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    full = files.filter(F.col("n") == bound).count()
    records = bronze.read_bronze(spark, f"{path}/bronze", schemas.BRONZE_TRACKING)
    return records.withColumn("full_files", F.lit(full).cast("long"))


@query("S06_bronze_scan")
def s06(spark, sf_dir):
    """Bronze with a line of other text next to each error event."""
    path = work_dir(spark, "s06")
    text_tracking(spark, sf_dir).write.json(path)
    given = inputs.given(spark, sf_dir, "events")
    given.filter(F.col("event_type") == "error").select(
        F.concat(F.lit("not json: "), "props")
    ).write.mode("append").text(path)
    return bronze.read_bronze(spark, path, schemas.BRONZE_TRACKING)


@query("S07_table_overwrite")
def s07(spark, sf_dir):
    """The second write replaces the first."""
    path = work_dir(spark, "s07")
    tables.write_table(inputs.bronze_tracking(spark, sf_dir), path)
    tables.write_table(inputs.tracking(spark, sf_dir), path)
    return tables.read_table(spark, path)


@query("S08_table_scan")
def s08(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/events.parquet")


@query("S09_keyed_upsert")
def s09(spark, sf_dir):
    """A first load under another SLA, then one under the usual SLA, twice."""
    path = work_dir(spark, "s09")
    pair = inputs.shipments(spark, sf_dir), inputs.tracking(spark, sf_dir)
    keys = fixed.SERVING_KEYS["delivery_performance"]
    serving.upsert(spark, gold.delivery_performance(*pair, sla_days=20), path, keys)
    for _ in range(2):
        serving.upsert(spark, gold.delivery_performance(*pair), path, keys)
    return serving.read_current(spark, path)


NEWEST_EVENT = {"keys": ["shipment_id"], "newest_by": ["event_timestamp", "event_id"]}


def streamed_table(spark, sf_dir, label):
    """The newest event of each shipment from three micro-batches, the latest events first."""
    path = work_dir(spark, label)
    events = text_tracking(spark, sf_dir)
    for part in (2, 1, 0):
        topic.publish(events.filter(F.col("event_id") % 3 == part), fmt="text", path=f"{path}/topic")
        messages = topic.subscribe(
            spark, schemas.BRONZE_TRACKING, fmt="text", path=f"{path}/topic"
        )
        drained(
            serving.upsert_stream(
                silver.typed_tracking(messages),
                f"{path}/table",
                checkpoint=f"{path}/checkpoint",
                **NEWEST_EVENT,
            )
        )
    return f"{path}/table"


@query("S09_streamed_upsert")
def s09_streamed(spark, sf_dir):
    return serving.read_current(spark, streamed_table(spark, sf_dir, "s09-stream"), **NEWEST_EVENT)


@query("S09_compacted_upsert")
def s09_compacted(spark, sf_dir):
    path = streamed_table(spark, sf_dir, "s09-compact")
    serving.compact(spark, path, **NEWEST_EVENT)
    return serving.read_current(spark, path)


@query("S09_partial_upsert")
def s09_partial(spark, sf_dir):
    """A table of many files under another SLA, of which a load of one origin's shipments under
    the usual SLA replaces its own."""
    path = work_dir(spark, "s09-partial")
    pair = inputs.shipments(spark, sf_dir), inputs.tracking(spark, sf_dir)
    keys = fixed.SERVING_KEYS["delivery_performance"]
    serving.upsert(spark, gold.delivery_performance(*pair, sla_days=20), path, keys, partitions=16, unique=True)
    changed = gold.delivery_performance(*pair).filter("origin = 'NATION_7'")
    serving.upsert(spark, changed, path, keys, unique=True)
    return serving.read_current(spark, path)


@query("S10_redistribute")
def s10(spark, sf_dir):
    return tables.redistribute(inputs.snapshot(spark, sf_dir), 2)


@query("S11_serving_scan")
def s11(spark, sf_dir):
    layout = staged_serving(spark, sf_dir, "s11")
    return in_cents(serving.fetch(spark, layout.serving, "routes"), "total_value_at_risk")


@query("S11_live_snapshot")
def s11_live(spark, sf_dir):
    """A snapshot from before any event, which a stream of events keeps up to date, by name."""
    path = work_dir(spark, "s11-live")
    table = f"{path}/serving/{fixed.SERVING_TABLES['shipments']}"
    shipments = inputs.shipments(spark, sf_dir)
    keys = fixed.SERVING_KEYS["shipment_snapshot"]
    before = gold.shipment_snapshot(shipments, inputs.tracking(spark, sf_dir).limit(0))
    serving.upsert(spark, before, table, keys, unique=True)
    events = text_tracking(spark, sf_dir)
    for errors in (True, False):
        late = (F.col("event_type") == fixed.CANCELLED) == F.lit(errors)
        topic.publish(events.filter(late), fmt="text", path=f"{path}/topic")
        messages = topic.subscribe(spark, schemas.BRONZE_TRACKING, fmt="text", path=f"{path}/topic")
        news = gold.status_columns(silver.typed_tracking(messages).join(shipments, "shipment_id"))
        drained(serving.upsert_stream(news, table, keys, f"{path}/checkpoint", ["last_updated_at"]))
    return serving.fetch(spark, f"{path}/serving", "shipments")


@query("S12_all_tables_bundle")
def s12(spark, sf_dir):
    layout = staged_serving(spark, sf_dir, "s12")
    return in_cents(wide(serving.fetch_all(spark, layout.serving)), "total_value_at_risk")


@query("S13_json_safe_rows")
def s13(spark, sf_dir):
    return rendering.json_safe(inputs.performance(spark, sf_dir))


# Projections and scalar functions


@query("P01_lenient_double")
def p01(spark, sf_dir):
    return inputs.rough_shipments(spark, sf_dir).select(
        "order_key",
        parsing.to_double(F.col("weight_kg")).alias("weight_kg"),
        parsing.to_double(F.col("declared_value")).alias("declared_value"),
    )


@query("P02_lenient_date")
def p02(spark, sf_dir):
    return inputs.rough_shipments(spark, sf_dir).select(
        "order_key", parsing.to_day(F.col("shipping_date")).alias("shipping_date")
    )


@query("P03_lenient_timestamp")
def p03(spark, sf_dir):
    return inputs.rough_tracking(spark, sf_dir).select(
        "event_id",
        "shipment_id",
        parsing.to_instant(F.col("event_timestamp")).alias("event_timestamp"),
    )


@query("P04_renaming_projection")
def p04(spark, sf_dir):
    shipments, tracking = pipeline.silver_tables(spark, staged_silver(spark, sf_dir, "p04"))
    return gold.status_columns(gold.events_with_shipments(shipments, tracking))


@query("P05_renamed_pivot_columns")
def p05(spark, sf_dir):
    return milestones.milestone_times(inputs.tracking(spark, sf_dir)).select(
        "shipment_id", "picked_up_time", "delivered_time"
    )


@query("P06_dropped_helper")
def p06(spark, sf_dir):
    return newest.first_ranked(
        inputs.tracking(spark, sf_dir), ["location"], ["event_timestamp", "event_id"]
    )


@query("P07_elapsed_days")
def p07(spark, sf_dir):
    return milestones.milestone_times(inputs.tracking(spark, sf_dir)).select(
        "shipment_id",
        measures.elapsed_days(F.col("picked_up_time"), F.col("delivered_time")).alias("days"),
    )


@query("P08_sla_flag")
def p08(spark, sf_dir):
    days = measures.elapsed_days(F.col("picked_up_time"), F.col("delivered_time"))
    return milestones.milestone_times(inputs.tracking(spark, sf_dir)).select(
        "shipment_id",
        measures.breaches_sla(days).alias("is_delayed"),
        measures.breaches_sla(days, 10).alias("over_ten_days"),
    )


@query("P09_stripped_text")
def p09(spark, sf_dir):
    return inputs.rough_shipments(spark, sf_dir).select(
        "order_key",
        parsing.stripped(F.col("origin")).alias("origin"),
        parsing.stripped(F.col("destination")).alias("destination"),
    )


@query("P10_json_round_trip")
def p10(spark, sf_dir):
    messages = topic.to_messages(inputs.rough_tracking(spark, sf_dir))
    return topic.from_messages(messages, schemas.BRONZE_TRACKING)


@query("P11_route_label")
def p11(spark, sf_dir):
    return inputs.shipments(spark, sf_dir).select(
        "shipment_id", measures.route_label(F.col("origin"), F.col("destination")).alias("route")
    )


@query("P12_outcome_label")
def p12(spark, sf_dir):
    return inputs.performance(spark, sf_dir).select(
        "shipment_id", measures.outcome(F.col("is_delayed")).alias("outcome")
    )


@query("P13_lenient_read_back")
def p13(spark, sf_dir):
    """JSON text parsed back, with hub names standing where an instant should."""
    safe = rendering.json_safe(inputs.snapshot(spark, sf_dir))
    garbled = F.when(F.col("current_status") == fixed.CANCELLED, F.col("current_location"))
    safe = safe.withColumn("last_updated_at", garbled.otherwise(F.col("last_updated_at")))
    return report.restored("shipments", safe)


@query("P14_unknown_delay_is_false")
def p14(spark, sf_dir):
    return report.settled(inputs.performance(spark, sf_dir)).select(
        "shipment_id", "delivery_duration_days", "is_delayed"
    )


@query("P15_kpi_text")
def p15(spark, sf_dir):
    bundle = inputs.gold_tables(spark, sf_dir)
    row = kpi.kpis(bundle["shipments"], bundle["performance"], bundle["routes"])
    return kpi.kpi_cards(row)


@query("P16_any_value_as_text")
def p16(spark, sf_dir):
    orders = inputs.given(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    orders = orders.withColumns(
        {"is_open": F.col("o_orderstatus") == "O", "large": price * 1024, "small": price / 2**30}
    )
    return orders.select(
        *[parsing.as_text(F.col(one.name), one.dataType).alias(one.name) for one in orders.schema]
    )


# Filters and predicates


@query("F01_key_present")
def f01(spark, sf_dir):
    rows = silver.typed_shipments(inputs.rough_shipments(spark, sf_dir))
    return rows.filter(F.col("shipment_id").isNotNull()).select(
        "order_key", "shipment_id", "weight_kg", "declared_value", "shipping_date"
    )


@query("F02_timestamp_parsed")
def f02(spark, sf_dir):
    rows = silver.typed_tracking(inputs.rough_tracking(spark, sf_dir))
    return rows.filter(F.col("event_timestamp").isNotNull())


@query("F03_literal_membership")
def f03(spark, sf_dir):
    return milestones.milestone_events(inputs.tracking(spark, sf_dir))


@query("F04_rank_is_one")
def f04(spark, sf_dir):
    return newest.first_ranked(
        inputs.tracking(spark, sf_dir), ["shipment_id"], ["event_timestamp", "event_id"]
    )


@query("F05_slicer_filter")
def f05(spark, sf_dir):
    chosen = Selection(origin="NATION_3", destination="BUILDING", delay=fixed.ON_TIME_LABEL)
    return slicers.narrow(inputs.performance(spark, sf_dir), chosen)


@query("F06_slicer_routing")
def f06(spark, sf_dir):
    chosen = Selection(origin="NATION_7", delay=fixed.DELAYED_LABEL)
    visible = slicers.narrow_all(inputs.gold_tables(spark, sf_dir), chosen)
    return in_cents(wide(visible), "total_value_at_risk")


@query("F07_text_search")
def f07(spark, sf_dir):
    return slicers.search(inputs.snapshot(spark, sf_dir), " hub-[3-5]|nation_1.*|^cancel ")


@query("F07_literal_search")
def f07_literal(spark, sf_dir):
    return slicers.search(inputs.performance(spark, sf_dir), "1.2", regex=False)


@query("F07_large_amounts")
def f07_large(spark, sf_dir):
    """Amounts above ten million, found by their digits."""
    orders = inputs.given(spark, sf_dir, "orders")
    amounts = orders.select("o_orderkey", (F.col("o_totalprice") * 1024).alias("amount"))
    return slicers.search(amounts, "00000|[0-9]{8}[.]5", regex=True)


@query("F08_open_shipments")
def f08(spark, sf_dir):
    return inputs.snapshot(spark, sf_dir).filter(measures.is_open(F.col("current_status")))


@query("F09_dated_rows")
def f09(spark, sf_dir):
    rows = silver.typed_shipments(inputs.rough_shipments(spark, sf_dir))
    return ranking.dated(rows).select("order_key", "shipping_date")


# Joins


@query("J01_shipments_with_milestones")
def j01(spark, sf_dir):
    times = milestones.milestone_times(inputs.tracking(spark, sf_dir))
    return inputs.shipments(spark, sf_dir).join(times, "shipment_id", "inner")


@query("J02_events_with_shipments")
def j02(spark, sf_dir):
    shipments, tracking = pipeline.silver_tables(spark, staged_silver(spark, sf_dir, "j02"))
    return gold.events_with_shipments(shipments, tracking)


@query("J02_events_of_hot_shipments")
def j02_hot(spark, sf_dir):
    """Behind the silver jobs, where every shipment with a thousandth of all events is spread."""
    pair = inputs.shipments(spark, sf_dir), inputs.tracking(spark, sf_dir)
    return gold.events_with_shipments(*pair, heavy_share=0.001)


@query("J03_shipments_with_latest_event")
def j03(spark, sf_dir):
    latest = gold.latest_events(inputs.tracking(spark, sf_dir))
    return inputs.shipments(spark, sf_dir).join(latest, "shipment_id", "left")


# Aggregations


@query("A01_milestone_pivot")
def a01(spark, sf_dir):
    """Pivot per user of the rough feed, where event types repeat."""
    events = silver.typed_tracking(inputs.rough_tracking(spark, sf_dir))
    return milestones.milestone_times(events)


@query("A02_route_metrics")
def a02(spark, sf_dir):
    return in_cents(inputs.routes(spark, sf_dir), "total_value_at_risk")


@query("A03_one_shipment_per_key")
def a03_shipments(spark, sf_dir):
    rough = inputs.rough_shipments(spark, sf_dir)
    return silver.silver_shipments(rough, ["shipping_date", "order_key"])


@query("A03_one_event_per_key")
def a03_events(spark, sf_dir):
    """All events without an id are one event."""
    return silver.silver_tracking(inputs.rough_tracking(spark, sf_dir))


@query("A04_status_mix")
def a04(spark, sf_dir):
    return ranking.status_mix(inputs.snapshot(spark, sf_dir))


@query("A05_delay_split")
def a05(spark, sf_dir):
    return ranking.delay_split(inputs.performance(spark, sf_dir))


@query("A06_top_origins")
def a06_origins(spark, sf_dir):
    return ranking.top_values(inputs.performance(spark, sf_dir), "origin")


@query("A06_top_destinations")
def a06_destinations(spark, sf_dir):
    return ranking.top_values(inputs.performance(spark, sf_dir), "destination")


@query("A07_duration_histogram")
def a07(spark, sf_dir):
    return histogram(inputs.performance(spark, sf_dir), "delivery_duration_days")


@query("A08_value_at_risk_by_location")
def a08(spark, sf_dir):
    ranked = ranking.value_at_risk_by_location(inputs.routes(spark, sf_dir))
    return in_cents(ranked, "value_at_risk")


@query("A09_daily_volume")
def a09(spark, sf_dir):
    return ranking.daily_volume(inputs.performance(spark, sf_dir))


@query("A10_busiest_routes")
def a10(spark, sf_dir):
    return ranking.busiest_routes(inputs.routes(spark, sf_dir))


@query("A11_total_shipments")
def a11(spark, sf_dir):
    return kpi.shipment_kpis(inputs.snapshot(spark, sf_dir)).select("total_shipments")


@query("A12_in_transit")
def a12(spark, sf_dir):
    return kpi.shipment_kpis(inputs.snapshot(spark, sf_dir)).select("in_transit")


@query("A13_delayed_shipments")
def a13(spark, sf_dir):
    return kpi.delay_kpis(inputs.performance(spark, sf_dir)).select("delayed_shipments")


@query("A14_on_time_rate")
def a14(spark, sf_dir):
    return kpi.delay_kpis(inputs.performance(spark, sf_dir)).select("on_time_pct")


@query("A15_value_at_risk")
def a15(spark, sf_dir):
    return in_cents(kpi.risk_kpi(inputs.routes(spark, sf_dir)), "value_at_risk")


# Window, sort, top-k, set operations


@query("W01_latest_event_per_shipment")
def w01(spark, sf_dir):
    return gold.latest_events(inputs.tracking(spark, sf_dir))


@query("T01_top_counts")
def t01(spark, sf_dir):
    counts = ranking.counts_of(inputs.bronze_shipments(spark, sf_dir), "shipping_date")
    return ranking.largest(counts, "n", "shipping_date")


@query("T02_largest_values")
def t02(spark, sf_dir):
    rows = inputs.performance(spark, sf_dir).select("shipment_id", "declared_value")
    return ranking.largest(rows, "declared_value", "shipment_id")


@query("T03_display_order")
def t03(spark, sf_dir):
    counts = ranking.counts_of(inputs.bronze_shipments(spark, sf_dir), "shipping_date")
    return ranking.for_display(counts, "n", "shipping_date")


@query("U01_slicer_values")
def u01(spark, sf_dir):
    bundle = inputs.gold_tables(spark, sf_dir)
    return slicers.slicer_values("origin", bundle["shipments"], bundle["performance"])


# Streaming


@query("R01_feed_to_topic")
def r01(spark, sf_dir):
    path = work_dir(spark, "r01")
    drained(
        feeds.feed_to_topic(
            spark,
            csv_copy(spark, sf_dir, "r01-feed"),
            f"{path}/checkpoint",
            fmt="text",
            path=f"{path}/topic",
        )
    )
    return topic.read_topic(spark, schemas.BRONZE_SHIPMENTS, fmt="text", path=f"{path}/topic")


@query("R02_topic_to_bronze")
def r02(spark, sf_dir):
    """Messages that arrive between two runs land once each."""
    path = work_dir(spark, "r02")
    for messages in (text_tracking(spark, sf_dir), inputs.rough_tracking(spark, sf_dir)):
        topic.publish(messages, fmt="text", path=f"{path}/topic")
        drained(
            feeds.topic_to_bronze(
                spark,
                f"{path}/bronze",
                f"{path}/checkpoint",
                fmt="text",
                path=f"{path}/topic",
            )
        )
    return bronze.read_bronze(spark, f"{path}/bronze", schemas.BRONZE_TRACKING)


def events_with_props(spark, sf_dir):
    events = inputs.given(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "props"
    )
    return text_tracking(spark, sf_dir).join(events, "event_id")


def landed(spark, path):
    drained(
        feeds.topic_to_bronze(
            spark, f"{path}/bronze", f"{path}/checkpoint", fmt="text", path=f"{path}/topic"
        )
    )


@query("R02_unknown_fields")
def r02_unknown(spark, sf_dir):
    """A field that the bronze schema does not know stays in bronze."""
    path = work_dir(spark, "r02-unknown")
    topic.publish(events_with_props(spark, sf_dir), fmt="text", path=f"{path}/topic")
    landed(spark, path)
    schema = schemas.all_strings([*schemas.BRONZE_TRACKING.names, "props"])
    return bronze.read_bronze(spark, f"{path}/bronze", schema)


@query("R02_rejects")
def r02_rejects(spark, sf_dir):
    """Values that are no JSON objects, one for each error event, next to whole messages."""
    path = work_dir(spark, "r02-rejects")
    message_folder(spark, sf_dir, f"{path}/topic")
    events = inputs.given(spark, sf_dir, "events").filter("event_type = 'error'")
    events.select(F.concat(F.lit("["), "props", F.lit("] "), F.col("event_id").cast("string"))).write.mode(
        "append"
    ).text(f"{path}/topic")
    landed(spark, path)
    rejects = bronze.rejects_of(f"{path}/bronze")
    return spark.read.option("recursiveFileLookup", True).text(rejects)


@query("R03_replay_tolerance")
def r03(spark, sf_dir):
    """The topic is read twice from the start; the silver job does not show it."""
    path = work_dir(spark, "r03")
    layout = Layout(path, replays=["replayed"])
    message_folder(spark, sf_dir, f"{path}/topic")
    for number, folder in enumerate(layout.tracking_folders):
        drained(
            feeds.topic_to_bronze(
                spark,
                folder,
                f"{path}/checkpoint-{number}",
                fmt="text",
                path=f"{path}/topic",
            )
        )
    pipeline.clean_tracking(spark, layout)
    return tables.read_table(spark, layout.silver_tracking)


# Named jobs


@query("G01_silver_shipments")
def g01(spark, sf_dir):
    """Rough text, many rows per shipment, and missing ids."""
    layout = Layout(work_dir(spark, "g01"))
    inputs.rough_shipments(spark, sf_dir).drop("order_key").write.json(layout.bronze_shipments)
    pipeline.clean_shipments(spark, layout)
    return tables.read_table(spark, layout.silver_shipments)


@query("G02_silver_tracking")
def g02(spark, sf_dir):
    """Rough text, missing ids, and every event a second time, an hour on and elsewhere."""
    layout = Layout(work_dir(spark, "g02"))
    rough = inputs.rough_tracking(spark, sf_dir)
    later = F.date_format(
        parsing.to_instant(F.col("event_timestamp")) + F.expr("INTERVAL 1 HOUR"),
        "yyyy-MM-dd HH:mm:ss.SSSSSS",
    )
    again = rough.withColumns({"event_timestamp": later, "location": F.lit("HUB-X")})
    rough.unionByName(again).write.json(layout.bronze_tracking)
    pipeline.clean_tracking(spark, layout)
    return tables.read_table(spark, layout.silver_tracking)


@query("G02_incremental_silver")
def g02_incremental(spark, sf_dir):
    """Rough events in three runs: the errors, all of them again from another query together
    with the rest, and a last run with nothing new."""
    path = work_dir(spark, "g02-incremental")
    layout = Layout(path, replays=["replayed"], incremental=True)
    rough = inputs.rough_tracking(spark, sf_dir)
    parts = (rough.filter("event_id IS NULL"), rough, rough.limit(0))
    for folder, part in zip((*layout.tracking_folders, layout.bronze_tracking), parts, strict=True):
        topic.publish(part, fmt="text", path=f"{path}/topic-{folder.count('replayed')}")
        drained(
            feeds.topic_to_bronze(
                spark,
                folder,
                f"{path}/checkpoint-{folder.count('replayed')}",
                fmt="text",
                path=f"{path}/topic-{folder.count('replayed')}",
            )
        )
        pipeline.clean_tracking(spark, layout)
    return serving.read_current(spark, layout.silver_tracking)


@query("G03_delivery_performance")
def g03(spark, sf_dir):
    layout = staged_silver(spark, sf_dir, "g03")
    pipeline.build_performance(spark, layout)
    return tables.read_table(spark, layout.performance)


@query("G04_route_optimization")
def g04(spark, sf_dir):
    layout = staged_silver(spark, sf_dir, "g04")
    pipeline.build_routes(spark, layout)
    return in_cents(tables.read_table(spark, layout.routes), "total_value_at_risk")


@query("G04_followed_routes")
def g04_followed(spark, sf_dir):
    """Orders of one priority and errors first, then all, so that most shipments change, then
    the same events once more: route metrics follow the changes of both tables."""
    path = work_dir(spark, "g04-followed")
    layout = Layout(path, incremental=True, follow_routes=True)
    shipments, tracking = inputs.bronze_shipments(spark, sf_dir), text_tracking(spark, sf_dir)
    urgent = inputs.given(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    urgent = urgent.select(F.col("o_orderkey").alias("order_key"))
    some = shipments.join(urgent, "order_key", "left_semi")
    errors = tracking.filter(F.col("event_type") == fixed.CANCELLED)
    for run, (shipped, tracked) in enumerate(((some, errors), (shipments, tracking), (None, tracking))):
        if shipped is not None:
            shipped.drop("order_key").write.json(f"{layout.bronze_shipments}/batch-a-{run:010d}")
        tracked.write.json(f"{layout.bronze_tracking}/batch-a-{run:010d}")
        for step in (pipeline.clean_shipments, pipeline.clean_tracking, pipeline.build_routes):
            step(spark, layout)
    return tables.read_table(spark, layout.routes)


@query("G05_shipment_snapshot")
def g05(spark, sf_dir):
    layout = staged_silver(spark, sf_dir, "g05")
    pipeline.build_snapshot(spark, layout)
    return tables.read_table(spark, layout.snapshot)


@query("G06_serving_load")
def g06(spark, sf_dir):
    """Loaded twice, as a re-run would."""
    layout = staged_serving(spark, sf_dir, "g06")
    pipeline.serve(spark, layout, partitions=2)
    return in_cents(wide(serving.fetch_all(spark, layout.serving)), "total_value_at_risk")


def long_report(spark, sf_dir, selection):
    layout = staged_gold(spark, sf_dir, "report")
    bundle = {
        "shipments": tables.read_table(spark, layout.snapshot),
        "performance": tables.read_table(spark, layout.performance),
        "routes": tables.read_table(spark, layout.routes),
    }
    return in_cents(report.long_form(report.report(bundle, selection)), "value")


@query("G07_report")
def g07(spark, sf_dir):
    return long_report(spark, sf_dir, Selection())


@query("G07_report_sliced")
def g07_sliced(spark, sf_dir):
    return long_report(
        spark, sf_dir, Selection(destination="MACHINERY", delay=fixed.DELAYED_LABEL)
    )


def long_report_from_cube(spark, sf_dir, selection):
    layout = staged_gold(spark, sf_dir, "report-cube")
    path = f"{layout.gold}/cube"
    names = {"shipments": layout.snapshot, "performance": layout.performance, "routes": layout.routes}
    bundle = {name: tables.read_table(spark, path) for name, path in names.items()}
    tables.write_table(cube.cube_of(bundle), path)
    datasets = cube.report_from_cube(tables.read_table(spark, path), selection)
    return in_cents(report.long_form(datasets), "value")


@query("G07_report_from_cube")
def g07_cube(spark, sf_dir):
    return long_report_from_cube(spark, sf_dir, Selection())


@query("G07_sliced_from_cube")
def g07_sliced_cube(spark, sf_dir):
    return long_report_from_cube(
        spark, sf_dir, Selection(destination="MACHINERY", delay=fixed.DELAYED_LABEL)
    )


@query("G08_dashboard_load")
def g08(spark, sf_dir):
    layout = staged_serving(spark, sf_dir, "g08")
    loaded = report.load_dashboard(spark, layout.serving)
    lists = [
        loaded[name].select(
            F.lit(name).alias("dataset"),
            F.col(column).alias("label"),
            F.lit(None).cast("double").alias("value"),
        )
        for name, column in (("origins", "origin"), ("destinations", "destination"))
    ]
    rows = report.long_form(loaded["report"]).unionByName(lists[0]).unionByName(lists[1])
    return in_cents(rows, "value")
