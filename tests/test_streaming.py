import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tests.helpers import bag, finish, rows
from waybill import fixed, schemas
from waybill.layout import Layout
from waybill.plans import pipeline, silver
from waybill.sources import bronze, csv_feed, serving, topic
from waybill.streaming import feeds

HEADER = " event_id ,shipment_id,event_type, event_timestamp,location\n"


def lines(*numbers):
    return HEADER + "".join(
        f" e{n} ,s{n % 3}, Delivered ,2026-05-{n % 28 + 1:02d} 10:00:00,\n" for n in numbers
    )


def add_file(folder, name, *numbers):
    path = Path(folder("feed"))
    path.mkdir(exist_ok=True)
    (path / name).write_text(lines(*numbers), encoding="utf-8")
    return str(path)


def run_feed(spark, folder, path, checkpoint="c1", to="topic"):
    finish(
        feeds.feed_to_topic(
            spark, path, folder(checkpoint), fmt="text", path=folder(to),
            feed_options={"maxFilesPerTrigger": 1},
        )
    )


def run_sink(spark, folder, checkpoint="c2", to="bronze", **options):
    finish(
        feeds.topic_to_bronze(
            spark, folder(to), folder(checkpoint), fmt="text", path=folder("topic"), **options
        )
    )
    return bronze.read_bronze(spark, folder(to), schemas.BRONZE_TRACKING)


def test_feed_reaches_bronze_once_however_often_it_is_resumed(spark, folder):
    path = add_file(folder, "a.csv", *range(5))
    run_feed(spark, folder, path)
    assert run_sink(spark, folder).count() == 5
    add_file(folder, "b.csv", *range(5, 9))
    for _ in range(2):
        run_feed(spark, folder, path)
        landed = run_sink(spark, folder)
    assert bag(landed) == bag(csv_feed.read_csv_feed(spark, path))
    assert landed.count() == 9


def test_replay_leaves_silver_unchanged(spark, folder):
    path = add_file(folder, "a.csv", *range(20))
    run_feed(spark, folder, path)
    once = run_sink(spark, folder)
    run_sink(spark, folder, checkpoint="c3", to="bronze-again")
    twice = bronze.read_bronze(
        spark, [folder("bronze"), folder("bronze-again")], schemas.BRONZE_TRACKING
    )
    assert (once.count(), twice.count()) == (20, 40)
    assert bag(silver.silver_tracking(twice)) == bag(silver.silver_tracking(once))


def test_stream_equals_batch(spark, folder):
    path = add_file(folder, "a.csv", *range(30))
    run_feed(spark, folder, path)
    from_topic = topic.read_topic(
        spark, schemas.BRONZE_TRACKING, fmt="text", path=folder("topic")
    )
    assert bag(from_topic) == bag(csv_feed.read_csv_feed(spark, path))


def test_bronze_files_can_be_followed_as_a_stream(spark, folder):
    run_feed(spark, folder, add_file(folder, "a.csv", *range(6)))
    landed = run_sink(spark, folder)
    stream = bronze.stream_bronze(spark, folder("bronze"), schemas.BRONZE_TRACKING)
    finish(
        stream.writeStream.format("parquet").option("checkpointLocation", folder("c4"))
        .trigger(availableNow=True).start(folder("copy"))
    )
    assert bag(spark.read.parquet(folder("copy"))) == bag(landed)


def test_declared_sink_bounds_records_per_file(spark, folder):
    run_feed(spark, folder, add_file(folder, "a.csv", *range(35)))
    stream = topic.follow(spark, fmt="text", path=folder("topic"))
    finish(bronze.declared_sink(stream, folder("sunk"), folder("c5"), fixed.SINK_FLUSH_RECORDS))
    landed = spark.read.option("recursiveFileLookup", True).text(folder("sunk"))
    per_file = landed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert landed.count() == 35
    assert per_file <= 10


def files_of(folder_path):
    """Lines of each file that readers see, by the order of their batches."""
    found = sorted(Path(folder_path).glob("batch-*/part-*"))
    return [path.read_text().splitlines() for path in found]


def until(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "waited too long"
        time.sleep(0.2)


def test_declared_sink_flushes_by_count_or_by_time(spark, folder):
    """25 records make up two flushes at once; the other five come when their time has come."""
    run_feed(spark, folder, add_file(folder, "a.csv", *range(25)))
    stream = topic.follow(spark, fmt="text", path=folder("topic"))
    query = bronze.declared_sink(stream, folder("sunk"), folder("c6"), 10, "12 seconds", poll="500 milliseconds")
    try:
        until(lambda: len(files_of(folder("sunk"))) == 2)
        first = time.time()
        assert [len(lines) for lines in files_of(folder("sunk"))] == [10, 10]
        until(lambda: len(files_of(folder("sunk"))) == 3)
        assert time.time() - first > 6
        # A file of two more: they wait, and the next eight make up a flush with them.
        add_file(folder, "b.csv", 25, 26)
        run_feed(spark, folder, folder("feed"))
        add_file(folder, "c.csv", *range(27, 36))
        run_feed(spark, folder, folder("feed"))
        until(lambda: len(files_of(folder("sunk"))) == 4)
        assert sorted(map(len, files_of(folder("sunk")))) == [5, 10, 10, 10]
    finally:
        query.stop()
    # The one that was left lands after a restart.
    query = bronze.declared_sink(stream, folder("sunk"), folder("c6"), 10, "1 second", poll="500 milliseconds")
    try:
        until(lambda: len(files_of(folder("sunk"))) == 5)
    finally:
        query.stop()
    found = bronze.read_bronze(spark, folder("sunk"), schemas.BRONZE_TRACKING)
    assert found.count() == found.distinct().count() == 36


@pytest.mark.parametrize("n", [0, 7, 20, 33])
def test_a_flush_that_is_run_again_changes_nothing(spark, folder, n):
    """Batches as a stream gives them, each run twice, over several partitions."""
    path = folder("sunk")
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        for batch_id, (low, high) in enumerate([(0, n), (n, n + 4), (n + 4, n + 4), (n + 4, 50)]):
            for _ in range(2):
                batch = spark.range(low, high, 1, 3).selectExpr("to_json(struct(id)) AS value")
                bronze.flush(batch.unionAll(spark.sql("SELECT 'oops' AS value")), batch_id, path, 10, 10**9)
        for _ in range(2):
            bronze.flush(spark.range(0).selectExpr("string(id) AS value"), 4, path, 10, 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert [len(lines) for lines in files_of(path)] == [10] * 5
    found = bronze.read_bronze(spark, path, schemas.all_strings(["id"]))
    assert sorted(int(row.id) for row in found.collect()) == list(range(50))
    assert bag(bronze.read_rejects(spark, path)) == {("oops",): 4}


def test_kafka_flushes_by_options_of_its_source():
    assert bronze.flush_options(10, "30 seconds") == {"minOffsetsPerTrigger": 10, "maxTriggerDelay": "30 seconds"}


def test_kafka_is_the_default_topic(spark):
    """Its connector is not on the classpath here, so the attempt names it."""
    options = {"subscribe": fixed.TRACKING_TOPIC, "kafka.bootstrap.servers": "none:1"}
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topic.subscribe(spark, schemas.BRONZE_TRACKING, **options)


def test_from_csv_feeds_over_topics_to_serving(spark, folder):
    layout = Layout(folder("root"))
    paths = {name: folder(name) for name in feeds.TOPICS}
    for path in paths.values():
        Path(path).mkdir()
    Path(paths[fixed.SHIPMENT_TOPIC], "a.csv").write_text(
        "shipment_id,origin,destination,weight_kg,declared_value,shipping_date\n"
        "S1, A ,B,1.5,10.25,2026-05-01\nS2,A,C,,x,2026-05-02\n",
        encoding="utf-8",
    )
    Path(paths[fixed.TRACKING_TOPIC], "a.csv").write_text(
        "event_id,shipment_id,event_type,event_timestamp,location\n"
        "E1,S1,Picked Up,2026-05-01 08:00:00,H1\nE2,S1,Delivered,2026-05-03 20:00:00,H2\n",
        encoding="utf-8",
    )
    for query in feeds.start_feeds(spark, layout, paths, fmt="text"):
        finish(query)
    for query in feeds.start_ingest(spark, layout, fmt="text"):
        finish(query)
    pipeline.run(spark, layout.root)
    served = serving.fetch_all(spark, layout.serving)
    assert rows(served["performance"].select(
        "shipment_id", "origin", "declared_value", "delivery_duration_days", "is_delayed"
    )) == [("S1", "A", 10.25, 2.5, False)]
    assert bag(served["shipments"].select("shipment_id", "current_status")) == {
        ("S1", "Delivered"): 1, ("S2", None): 1
    }
    assert bag(served["routes"]) == {
        ("A", "B", "H1", 1, 10.25, 1.5): 1, ("A", "B", "H2", 1, 10.25, 1.5): 1
    }


def test_messages_land_whole_and_broken_ones_aside(spark, folder):
    path = Path(folder("topic"))
    path.mkdir()
    sound = ['{"event_id": "1", "later": {"x": [1, 2]}}', '{"other": null}']
    broken = ["[1]", "oops", '{"event_id": "1"']
    (path / "a.txt").write_text("\n".join(sound + broken), encoding="utf-8")
    run_sink(spark, folder)
    read = spark.read.option("recursiveFileLookup", True)
    assert sorted(row.value for row in read.text(folder("bronze")).collect()) == sorted(sound)
    rejects = bronze.rejects_of(folder("bronze"))
    assert sorted(row.value for row in read.text(rejects).collect()) == sorted(broken)


def test_messages_of_several_lines_land_once_each(spark, folder):
    sound = ['{\n  "event_id": "1",\r\n  "later": [\n1\r]\n}\n', '{"event_id": "2\\n"}', '{"event_id": "3"}\n{"event_id": "4"}\n']
    aside = ['{"event_id":\n"5"\n', "a\r\nb \\n\n", "\\x", '"a\\nb"', '{"event_id": "6\n7"}', '{"event_id":\n"8"}\n{"event_id": "9"}']
    spark.createDataFrame([(one,) for one in sound + aside], "value string").write.parquet(folder("topic"))
    messages = spark.readStream.schema("value string").parquet(folder("topic"))
    finish(bronze.append_bronze(messages, folder("bronze"), folder("c")))
    found = bronze.read_bronze(spark, folder("bronze"), schemas.all_strings(["event_id", "later"]))
    assert bag(found) == {("1", "[1]"): 1, ("2\n", None): 1, ("3", None): 1, ("4", None): 1}
    assert bronze.broken_lines(spark, folder("bronze")).count() == 0
    assert sorted(row.value for row in bronze.read_rejects(spark, folder("bronze")).collect()) == sorted(aside)


def test_a_second_query_keeps_the_batches_of_the_first(spark, folder):
    run_feed(spark, folder, add_file(folder, "a.csv", *range(4)))
    run_sink(spark, folder, checkpoint="c1-sink")
    assert run_sink(spark, folder, checkpoint="c2-sink").count() == 8


def test_a_foreign_header_ends_a_streaming_table_and_names_the_file(spark, folder):
    path = add_file(folder, "a.csv", *range(4))
    Path(path, "b.csv").write_text("shipment_id,event_id\ns,e\n", encoding="utf-8")
    stream = csv_feed.stream_csv_feed(spark, path, schemas.all_strings(HEADER.strip("\n").split(",")))
    query = stream.writeStream.format("noop").option("checkpointLocation", folder("c1"))
    with pytest.raises(StreamingQueryException, match="b.csv"):
        query.trigger(availableNow=True).start().awaitTermination()


def test_feeds_take_each_file_by_its_own_header(spark, folder):
    path = add_file(folder, "a.csv", *range(4))
    Path(path, "b.csv").write_text(" note,event_id ,shipment_id\nn,x1,s1\n,x2,s2\n", encoding="utf-8")
    run_feed(spark, folder, path)
    Path(path, "empty.csv").write_text("", encoding="utf-8")
    Path(path, "c.csv").write_text("event_id\nx3\n", encoding="utf-8")
    for _ in range(2):
        run_feed(spark, folder, path)
    schema = schemas.all_strings(["event_id", "shipment_id", "note"])
    found = topic.read_topic(spark, schema, fmt="text", path=folder("topic"))
    assert bag(found.where("event_id LIKE 'x_'")) == {
        ("x1", "s1", "n"): 1, ("x2", "s2", ""): 1, ("x3", None, None): 1
    }
    assert found.count() == 7


def test_a_batch_of_files_that_died_lands_once(spark, folder):
    """The batch is run again by the next start, after it had landed and before it had."""
    path = add_file(folder, "a.csv", *range(4))
    place = {"fmt": "text", "path": folder("topic")}
    for dies_before in (True, False):
        def land(rows, name, dies_before=dies_before):
            if not dies_before:
                topic.publish_batch(rows, name, **place)
            raise RuntimeError("lost")

        query = csv_feed.each_csv_batch(spark, path, folder("c1"), land)
        with pytest.raises(StreamingQueryException, match="lost"):
            query.awaitTermination()
    add_file(folder, "b.csv", 4, 5)
    for _ in range(2):
        run_feed(spark, folder, path)
    assert topic.read_topic(spark, schemas.BRONZE_TRACKING, **place).count() == 6


def landed_folders(path):
    return sorted(one.name for one in Path(path).iterdir() if one.name[0] not in "_.")


def test_packed_batches_read_the_same(spark, folder):
    path = folder("bronze")

    def land(query, batch_id, low, high):
        spark.range(low, high).selectExpr("to_json(struct(id)) AS value").write.mode("overwrite").text(
            f"{path}/batch-{query}-{batch_id:010d}"
        )

    def ids():
        found = bronze.read_bronze(spark, path, schemas.all_strings(["id"]))
        return sorted(int(row.id) for row in found.collect())

    for batch_id in range(5):
        land("q", batch_id, 10 * batch_id, 10 * batch_id + 10)
    land("p", 7, 100, 105)
    spark.range(200, 203).selectExpr("to_json(struct(id)) AS value").write.text(f"{path}/other")
    known = [*range(50), *range(100, 105), *range(200, 203)]
    reader = bronze.read_bronze(spark, path, schemas.all_strings(["id"]))
    new, before = bronze.landed_since(spark, path, {})
    assert len(new) == 7
    assert bronze.pack(spark, path) == 4
    assert ids() == known
    # One that has listed the folders before still ends; a batch that is run again lands once.
    assert sorted(int(row.id) for row in reader.collect()) == known
    land("q", 4, 40, 50)
    assert ids() == known
    # A ledger from before has seen all of it, one from the middle sees the packed batches again.
    assert bronze.landed_since(spark, path, before) == ([], {})
    middle = dict(before) | {f"{path}/batch-q": 1}
    again, reached = bronze.landed_since(spark, path, middle)
    assert [one.rsplit("/", 1)[1] for one in again] == ["batch-q-0000000004", "packed-batch-q-0000000000-0000000003"]
    assert reached == {f"{path}/batch-q": 4}
    # Later batches are packed with the packed ones; what they hold goes after its time.
    land("q", 5, 50, 60)
    land("q", 6, 60, 61)
    known = sorted([*known, *range(50, 61)])
    assert bronze.pack(spark, path, grace_seconds=0) == 3
    assert ids() == known
    assert bronze.pack(spark, path, grace_seconds=0) == 0
    assert landed_folders(path) == ["batch-p-0000000007", "batch-q-0000000006", "other", "packed-batch-q-0000000000-0000000005"]
    assert ids() == known
    size = sum(part.stat().st_size for part in Path(path).rglob("part-*"))
    land("q", 7, 61, 62)
    assert bronze.pack(spark, path, target_bytes=size // 10) == 0
