"""Time the headline jobs and report queries; print one line of JSON.

The feeds are written once from the tables in $BENCH_SF_DIR, then each job runs
on files as it does in production: one warm-up, then the median of three runs.
"""

import json
import os
import statistics
import time

from checks import inputs
from checks.queries import drained
from waybill import schemas
from waybill.layout import Layout
from waybill.operators.slicers import Selection, search, slicer_values
from waybill.plans import cube, pipeline, report, silver
from waybill.session import build_session, work_dir
from waybill.sources import csv_feed, serving, tables, topic
from waybill.streaming import feeds

RUNS = 3


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def median_seconds(job):
    job()
    seconds = []
    for _ in range(RUNS):
        began = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds), 3)


def prepare(spark, sf_dir):
    layout = Layout(work_dir(spark, "bench"))
    inputs.bronze_shipments(spark, sf_dir).drop("order_key").write.json(layout.bronze_shipments)
    inputs.bronze_tracking(spark, sf_dir).write.json(layout.bronze_tracking)
    for step in pipeline.STEPS:
        step(spark, layout)
    feed = f"{layout.root}/feed"
    inputs.bronze_tracking(spark, sf_dir).write.option("header", True).csv(feed)
    topic.publish(inputs.bronze_tracking(spark, sf_dir), fmt="text", path=f"{layout.root}/topic")
    return layout, feed


def jobs(spark, layout, feed):
    yield "G01_silver_shipments", lambda: pipeline.clean_shipments(spark, layout)
    yield "G02_silver_tracking", lambda: pipeline.clean_tracking(spark, layout)
    yield "G03_delivery_performance", lambda: pipeline.build_performance(spark, layout)
    yield "G04_route_optimization", lambda: pipeline.build_routes(spark, layout)
    yield "G05_shipment_snapshot", lambda: pipeline.build_snapshot(spark, layout)
    yield "G06_serving_load", lambda: pipeline.serve(spark, layout)
    # Read only now: the jobs above replace the files of these tables.
    gold = {
        "shipments": tables.read_table(spark, layout.snapshot),
        "performance": tables.read_table(spark, layout.performance),
        "routes": tables.read_table(spark, layout.routes),
    }
    whole = report.report(gold)
    sliced = report.report(gold, Selection(destination="MACHINERY", delay="Delayed"))

    def all_of(datasets):
        for df in datasets.values():
            consume(df)

    def feed_to_topic():
        to = work_dir(spark, "bench-topic")
        query = feeds.feed_to_topic(
            spark, feed, f"{to}/checkpoint", schemas.BRONZE_TRACKING, fmt="text", path=f"{to}/topic"
        )
        drained(query)

    def topic_to_bronze():
        to = work_dir(spark, "bench-bronze")
        query = feeds.topic_to_bronze(
            spark,
            f"{to}/bronze",
            f"{to}/checkpoint",
            fmt="text",
            path=f"{layout.root}/topic",
        )
        drained(query)

    yield "G07_report", lambda: all_of(whole)
    yield "G07_report_sliced", lambda: all_of(sliced)
    held = f"{work_dir(spark, 'bench-cube')}/cube"
    yield "G07_cube", lambda: tables.write_table(cube.cube_of(gold), held)
    selection = Selection(destination="MACHINERY", delay="Delayed")
    yield "G07_report_from_cube", lambda: all_of(cube.report_from_cube(tables.read_table(spark, held)))
    yield (
        "G07_sliced_from_cube",
        lambda: all_of(cube.report_from_cube(tables.read_table(spark, held), selection)),
    )
    for name in ("kpis", *report.CHARTS):
        yield f"report_{name}", lambda name=name: consume(whole[name])
    yield "F07_text_search", lambda: consume(search(gold["performance"], "nation_1.*|hub"))
    yield (
        "U01_slicer_values",
        lambda: consume(slicer_values("origin", gold["shipments"], gold["performance"])),
    )
    yield (
        "S13_json_safe_bundle",
        lambda: all_of(serving.fetch_json_safe(spark, layout.serving)),
    )
    def streamed_upsert():
        to = work_dir(spark, "bench-upsert")
        messages = topic.subscribe(
            spark, schemas.BRONZE_TRACKING, fmt="text", path=f"{layout.root}/topic"
        )
        rule = {"keys": ["shipment_id"], "newest_by": ["event_timestamp", "event_id"]}
        drained(
            serving.upsert_stream(
                silver.typed_tracking(messages), f"{to}/table", checkpoint=f"{to}/c", **rule
            )
        )
        consume(serving.read_current(spark, f"{to}/table", **rule))

    yield "S09_streamed_upsert", streamed_upsert
    yield "S01_csv_scan", lambda: consume(csv_feed.read_csv_feed(spark, feed))
    yield "R01_feed_to_topic", feed_to_topic
    yield "R02_topic_to_bronze", topic_to_bronze


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    layout, feed = prepare(spark, sf_dir)
    seconds = {name: median_seconds(job) for name, job in jobs(spark, layout, feed)}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median wall times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
