"""Continuous feeds: CSV files to a topic, a topic to bronze.

Each query keeps its progress in its checkpoint. Starting one with a fresh checkpoint reads
everything again; the duplicates this puts into bronze vanish when silver keeps one row per key.
"""

from waybill import fixed
from waybill.sources.bronze import append_bronze
from waybill.sources.csv_feed import each_csv_batch
from waybill.sources.topic import follow, publish_batch


def feed_to_topic(
    spark, csv_path, checkpoint, schema=None, feed_options=None, trigger=None, **topic
):
    """Every row of the CSV files as a message, each file with the columns of its own header."""

    def land(rows, name):
        publish_batch(rows, name, **topic)

    options = feed_options or {}
    return each_csv_batch(spark, csv_path, checkpoint, land, schema, trigger=trigger, **options)


def topic_to_bronze(
    spark, bronze_path, checkpoint, trigger=None, max_records_per_file=None, **topic
):
    messages = follow(spark, **topic)
    return append_bronze(messages, bronze_path, checkpoint, trigger, max_records_per_file)


TOPICS = (fixed.TRACKING_TOPIC, fixed.SHIPMENT_TOPIC)


def start_feeds(spark, layout, csv_paths, fmt="kafka", trigger=None, **options):
    """One query per feed of `csv_paths` (topic name to folder), publishing to its topic.

    Formats other than Kafka keep a folder per topic under the layout's root.
    """
    started = []
    for name, csv_path in csv_paths.items():
        place = {"topic": name} if fmt == "kafka" else {"path": f"{layout.topics}/{name}"}
        checkpoint = f"{layout.checkpoints}/publish-{name}"
        started.append(
            feed_to_topic(
                spark, csv_path, checkpoint, trigger=trigger, fmt=fmt, **place, **options
            )
        )
    return started


def start_ingest(spark, layout, fmt="kafka", trigger=None, max_records_per_file=None, **options):
    """One query per topic, appending to its bronze folder."""
    folders = {
        fixed.TRACKING_TOPIC: layout.bronze_tracking,
        fixed.SHIPMENT_TOPIC: layout.bronze_shipments,
    }
    started = []
    for name, folder in folders.items():
        place = {"subscribe": name} if fmt == "kafka" else {"path": f"{layout.topics}/{name}"}
        checkpoint = f"{layout.checkpoints}/ingest-{name}"
        started.append(
            topic_to_bronze(
                spark,
                folder,
                checkpoint,
                trigger,
                max_records_per_file,
                fmt=fmt,
                **place,
                **options,
            )
        )
    return started
