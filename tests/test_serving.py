from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from tests.helpers import ROUTE, SNAPSHOT, at, bag, by_key, events, finish, plan, rows, shipments
from waybill import fixed, schemas
from waybill.layout import Layout
from waybill.operators.slicers import Selection, search
from waybill.plans import gold, pipeline, report, silver
from waybill.plans.serving import load_serving
from waybill.session import shuffles_sized_for
from waybill.sources import bronze, serving, tables


def keyed(spark, *items):
    return spark.createDataFrame(list(items), "k string, v int")


def test_upsert_adds_and_replaces(spark, folder):
    path = folder("t")
    serving.upsert(spark, keyed(spark, ("a", 1), ("b", 1)), path, ["k"])
    serving.upsert(spark, keyed(spark, ("b", 2), ("c", 2)), path, ["k"])
    expected = {("a", 1): 1, ("b", 2): 1, ("c", 2): 1}
    assert bag(serving.read_current(spark, path)) == expected
    serving.upsert(spark, keyed(spark, ("b", 2), ("c", 2)), path, ["k"])
    assert bag(serving.read_current(spark, path)) == expected


def test_null_keys_equal_each_other(spark, folder):
    path = folder("t")
    row = spark.createDataFrame([("A", None, "H", 1, 1.0, 1.0)], ROUTE)
    for _ in range(2):
        serving.upsert(spark, row, path, fixed.SERVING_KEYS["route_optimization"])
    assert serving.read_current(spark, path).count() == 1


def test_a_load_that_died_is_not_seen_and_is_written_again(spark, folder):
    path = folder("t")
    serving.upsert(spark, keyed(spark, ("a", 1)), path, ["k"])
    tables.write_table(keyed(spark, ("x", 9)), f"{path}/data-of-a-load-that-died")
    Path(path, "_manifests", ".staged-load").write_text("{")
    assert rows(serving.read_current(spark, path)) == [("a", 1)]
    serving.upsert(spark, keyed(spark, ("a", 2)), path, ["k"])
    assert rows(serving.read_current(spark, path)) == [("a", 2)]
    assert serving.versions(spark, path) == [1, 2]


def test_old_versions_go_but_the_one_before_stays(spark, folder):
    path = folder("t")
    for value in range(5):
        serving.upsert(spark, keyed(spark, ("a", value)), path, ["k"], grace_seconds=0)
    assert serving.versions(spark, path) == [4, 5]
    assert len(list(Path(path).glob("data-*"))) == 2
    serving.upsert(spark, keyed(spark, ("a", 9)), path, ["k"], keep_versions=1, grace_seconds=0)
    assert serving.versions(spark, path) == [6]
    assert len(list(Path(path).glob("data-*"))) == 1
    serving.upsert(spark, keyed(spark, ("a", 10)), path, ["k"], keep_versions=1)
    assert serving.versions(spark, path) == [6, 7]


def many_files(spark, path, n=20_000, files=20):
    table = spark.range(n).selectExpr("lpad(id, 8, '0') AS k", "1 AS v")
    serving.upsert(spark, table, path, ["k"], partitions=files, unique=True)
    return {file["path"]: file for file in serving.manifest(spark, path)["files"]}


def test_an_upsert_of_few_keys_rewrites_few_files(spark, folder):
    path = folder("t")
    before = many_files(spark, path)
    assert len(before) > 10 and all(file["low"] <= file["high"] for file in before.values())
    one_percent = spark.range(7000, 7200).selectExpr("lpad(id, 8, '0') AS k", "2 AS v")
    serving.upsert(spark, one_percent, path, ["k"])
    after = {file["path"] for file in serving.manifest(spark, path)["files"]}
    assert 1 <= len(before.keys() - after) <= 2
    found = serving.read_current(spark, path)
    assert bag(found.groupBy("v").count()) == {(1, 19_800): 1, (2, 200): 1}
    assert found.select("k").distinct().count() == 20_000


def test_keys_that_no_file_holds_rewrite_none(spark, folder):
    path = folder("t")
    before = many_files(spark, path)
    beyond = keyed(spark, ("00003000x", 5), ("99999999", 5))
    for _ in range(2):
        serving.upsert(spark, beyond, path, ["k"], newest_by=["v"])
        after = {file["path"] for file in serving.manifest(spark, path)["files"]}
        assert before.keys() <= after
    assert serving.read_current(spark, path).count() == 20_002


def test_keys_of_several_columns_with_nulls_find_their_files(spark, folder):
    path = folder("t")
    pairs = "IF(id % 7 = 0, NULL, id % 50) AS a", "DATE'2026-01-01' + INT(id / 50) AS b", "id AS v"
    serving.upsert(spark, spark.range(2000).selectExpr(*pairs), path, ["a", "b"], partitions=12)
    known = bag(serving.read_current(spark, path))
    change = spark.range(350, 420).selectExpr(*pairs[:2], "-id AS v")
    serving.upsert(spark, change, path, ["a", "b"])
    replaced = {(row.a, row.b): row.v for row in change.orderBy(change.v.asc()).collect()}
    for row in change.collect():
        replaced[row.a, row.b] = max(replaced[row.a, row.b], row.v)
    expected = {(a, b, replaced.get((a, b), v)): n for (a, b, v), n in known.items()}
    assert bag(serving.read_current(spark, path)) == expected


def test_a_load_that_was_overtaken_starts_over(spark, folder, monkeypatch):
    """Another writer commits between the reading and the commit of a load."""
    path = folder("t")
    serving.upsert(spark, keyed(spark, ("a", 1)), path, ["k"])
    written, others = serving._written, [("b", 7), ("a", 5)]

    def overtaken(*args):
        result = written(*args)
        if others:
            other = others.pop()
            monkeypatch.setattr(serving, "_written", written)
            serving.upsert(spark, keyed(spark, other), path, ["k"])
            monkeypatch.setattr(serving, "_written", overtaken)
        return result

    monkeypatch.setattr(serving, "_written", overtaken)
    serving.upsert(spark, keyed(spark, ("c", 3)), path, ["k"])
    assert bag(serving.read_current(spark, path)) == {("a", 5): 1, ("b", 7): 1, ("c", 3): 1}
    assert serving.versions(spark, path) == [1, 2, 3, 4]
    assert len(list(Path(path).glob("data-*"))) == 4


def test_concurrent_loads_lose_nothing(spark, folder):
    path = folder("t")
    with ThreadPoolExecutor(6) as pool:
        loads = [
            pool.submit(serving.upsert, spark, keyed(spark, (f"k{n}", n), ("all", n)), path, ["k"], newest_by=["v"])
            for n in range(6)
        ]
        for load in loads:
            load.result()
    expected = {(f"k{n}", n): 1 for n in range(6)} | {("all", 5): 1}
    assert bag(serving.read_current(spark, path)) == expected


def test_one_number_is_given_once(spark, folder):
    path = f"{folder('t')}/_manifests/v0000000001.json"
    serving._create(spark, path, "{}")
    with pytest.raises(serving.Conflict):
        serving._create(spark, path, "other")
    assert Path(path).read_text() == "{}"


def test_upsert_reduces_repeated_keys_when_told_the_order(spark, folder):
    path = folder("t")
    serving.upsert(spark, keyed(spark, ("a", 1), ("a", 3), ("a", 2)), path, ["k"], newest_by=["v"])
    assert rows(serving.read_current(spark, path)) == [("a", 3)]


def test_rows_are_sorted_within_files_when_asked(spark, folder):
    path = folder("t")
    rows_in = keyed(spark, *[(f"k{n}", n * 7 % 10) for n in range(10)])
    serving.upsert(spark, rows_in, path, ["k"], partitions=1, sort_by=["v"])
    assert [row.v for row in serving.read_current(spark, path).collect()] == list(range(10))


def test_unknown_names_are_turned_away(spark, folder):
    with pytest.raises(ValueError, match="shipments, performance, routes"):
        serving.fetch(spark, folder("none"), "orders")
    with pytest.raises(ValueError, match="no table"):
        serving.fetch(spark, folder("none"), "routes")


def test_streamed_upserts(spark, folder):
    source, path = folder("in"), folder("t")
    late = [("a", 2), ("b", 0)]
    for batch in ([("a", 1), ("a", 2), ("b", 1)], [("a", 3), ("c", 1)], late):
        keyed(spark, *batch).write.mode("append").json(source)
        stream = spark.readStream.schema("k string, v int").json(source)
        finish(serving.upsert_stream(stream, path, ["k"], folder("checkpoint"), newest_by=["v"]))
    expected = {("a", 3): 1, ("b", 1): 1, ("c", 1): 1}
    assert bag(serving.read_current(spark, path, ["k"], ["v"])) == expected
    # The table knows its keys and order.
    assert bag(serving.read_current(spark, path)) == expected
    assert len(serving.deltas(spark, path)) == 3
    for _ in range(2):
        serving.compact(spark, path)
        assert bag(serving.read_current(spark, path)) == expected
    assert serving.deltas(spark, path) == [] and serving.versions(spark, path) == [1, 2]


def test_a_reader_from_before_a_compaction_still_ends(spark, folder):
    path = folder("t")
    serving.upsert(spark, keyed(spark, ("a", 1), ("b", 1)), path, ["k"])
    serving.append_delta(keyed(spark, ("a", 2)), path, ["k"], ["v"], "one")
    reader = serving.read_current(spark, path)
    serving.compact(spark, path, grace_seconds=0)
    assert serving.deltas(spark, path) == []
    assert bag(reader) == {("a", 2): 1, ("b", 1): 1}
    # With nobody left who needs it, the delta goes; a batch that is run again lands once.
    for value in (3, 4):
        serving.upsert(spark, keyed(spark, ("c", value)), path, ["k"], grace_seconds=0)
    assert list(Path(path).glob("delta-*")) == []
    assert bag(serving.read_current(spark, path)) == {("a", 2): 1, ("b", 1): 1, ("c", 4): 1}


def test_only_rows_of_the_deltas_keys_are_reduced(spark, folder):
    path = folder("t")
    serving.upsert(spark, spark.range(1000).selectExpr("string(id) AS k", "1 AS v"), path, ["k"])
    serving.append_delta(keyed(spark, ("7", 0), ("8", 2), ("x", 3)), path, ["k"], ["v"], "one")
    serving.append_delta(keyed(spark, ("8", 1), ("y", 3)), path, ["k"], ["v"], "two")
    found = serving.read_current(spark, path)
    changed = {row.k: row.v for row in found.where("v <> 1 OR k = '7'").collect()}
    assert found.count() == 1002 and changed == {"7": 1, "8": 2, "x": 3, "y": 3}


def test_a_streamed_table_is_read_by_name(spark, folder):
    source, root = folder("in"), folder("serving")
    table = f"{root}/shipment_snapshot"
    first = spark.createDataFrame([("a", "O", "D", None, None, None), ("b", "O", "D", None, None, None)], SNAPSHOT)
    serving.upsert(spark, first, table, ["shipment_id"])
    news = spark.createDataFrame([("a", "O", "D", "Picked Up", "HUB", at("2026-05-01 00:00:00"))], SNAPSHOT)
    news.write.json(source)
    stream = spark.readStream.schema(SNAPSHOT).json(source)
    finish(serving.upsert_stream(stream, table, ["shipment_id"], folder("c"), newest_by=["last_updated_at"]))
    assert by_key(serving.fetch(spark, root, "shipments"), "shipment_id", "current_status") == {
        "a": ("Picked Up",),
        "b": (None,),
    }


def test_a_small_batch_writes_a_small_delta(spark, folder):
    path = folder("table")
    serving.upsert(spark, spark.range(200_000).selectExpr("string(id) AS k", "1 AS v"), path, ["k"])
    for _ in range(2):
        serving.append_delta(keyed(spark, ("7", 2), ("7", 3)), path, ["k"], ["v"], "one")
    (delta,) = serving.deltas(spark, path)
    assert rows(spark.read.parquet(delta)) == [("7", 3)]
    assert serving.read_current(spark, path).count() == 200_000
    assert serving.read_current(spark, path, ["k"], ["v"]).count() == 200_000


def test_one_load_keeps_one_row_per_key(spark, folder):
    path = folder("table")
    serving.upsert(spark, keyed(spark, ("a", 1), ("a", 2)), path, ["k"])
    assert rows(serving.read_current(spark, path)) == [("a", 2)]


def feed(spark, layout):
    shipped = shipments(spark, "a", "b")
    tracked = events(
        spark,
        ("1", "a", "Picked Up", "2026-05-01 00:00:00"),
        ("2", "a", "Delivered", "2026-05-09 00:00:00"),
    )
    shipped.withColumns(
        {name: shipped[name].cast("string") for name in ("weight_kg", "declared_value")}
    ).write.json(layout.bronze_shipments)
    for _ in range(2):
        tracked.withColumn("event_timestamp", tracked.event_timestamp.cast("string")).write.mode(
            "append"
        ).json(layout.bronze_tracking)
    return shipped, tracked


def test_pipeline_from_bronze_to_serving(spark, folder):
    layout = Layout(folder("root"))
    pair = feed(spark, layout)
    for _ in range(2):
        pipeline.run(spark, layout.root)
    served = serving.fetch_all(spark, layout.serving)
    assert bag(served["performance"]) == bag(gold.delivery_performance(*pair))
    assert bag(served["routes"]) == bag(gold.route_optimization(*pair))
    assert bag(served["shipments"]) == bag(gold.shipment_snapshot(*pair))
    load_serving(spark, layout.gold, layout.serving, partitions=2)
    assert bag(serving.fetch(spark, layout.serving, "shipments")) == bag(served["shipments"])
    loaded = report.load_dashboard(spark, layout.serving)
    assert rows(loaded["report"]["kpis"]) == [(2, 1, 1, 0.0, 20.0)]
    assert rows(loaded["origins"]) == [("A",)]
    text = serving.fetch_json_safe(spark, layout.serving)["performance"].first()
    assert text.picked_up_time == "2026-05-01T00:00:00"


def test_bucketed_shipments_give_the_same_tables_with_one_shuffle_less(spark, folder):
    plain, bucketed = Layout(folder("plain")), Layout(folder("bucketed"))
    for layout in (plain, bucketed):
        feed(spark, layout)
    plain = pipeline.run(spark, plain.root)
    bucketed = pipeline.run(spark, bucketed.root, buckets=4, shipments_table="bucketed_shipments")
    expected, found = [serving.fetch_all(spark, layout.serving) for layout in (plain, bucketed)]
    for name, df in expected.items():
        assert bag(found[name]) == bag(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with shuffles_sized_for(spark, partitions=4):
            pair = pipeline.silver_tables(spark, bucketed)
            for job, exchanges in (
                (gold.delivery_performance, 1),
                (gold.route_optimization, 3),
                (gold.shipment_snapshot, 1),
            ):
                assert plan(job(*pair)).count("Exchange") == exchanges
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_shipments")


def test_a_kept_dashboard_answers_as_a_fresh_one(spark, folder):
    layout = Layout(folder("root"))
    feed(spark, layout)
    pipeline.run(spark, layout.root)
    fresh = report.load_dashboard(spark, layout.serving)
    with report.kept_dashboard(serving.fetch_all(spark, layout.serving)) as kept:
        for name, df in fresh["report"].items():
            assert rows(kept["report"][name]) == rows(df), name
        assert all(df.is_cached for df in kept["tables"].values())
        chosen = report.report(kept["tables"], Selection(delay="Delayed"))
        assert search(chosen["performance"], "^A$").count() == 1
    assert not any(df.is_cached for df in kept["tables"].values())


def bytes_read(spark, group, job):
    """Input bytes of the jobs that `job` starts."""
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        job()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker, store = context.statusTracker(), context._jsc.sc().statusStore()
    stages = {k for one in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(one).stageIds}
    return sum(store.lastStageAttempt(k).inputBytes() for k in stages if tracker.getStageInfo(k))


def tracked(spark, low, high, hour):
    return spark.range(low, high).selectExpr(
        "IF(id % 10 = 0, NULL, 'event ' || id) AS event_id",
        "'shipment ' || id % 50 AS shipment_id",
        "'In Transit' AS event_type",
        f"date_format(TIMESTAMP'2026-05-01 {hour:02d}:00:00' + make_interval(0, 0, 0, 0, 0, 0, id / 1000), 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS event_timestamp",
        "'HUB-1' AS location",
    )


def test_incremental_silver_reads_only_what_is_new(spark, folder):
    layout = Layout(folder("root"), incremental=True, replays=["again"])
    feeds_of_silver = (layout.bronze_tracking, *layout.tracking_folders[1:])
    tracked(spark, 0, 200_000, 1).write.json(f"{layout.bronze_tracking}/batch-q-0000000000")
    pipeline.clean_tracking(spark, layout)
    batches = [
        # More events, repeated ids that are later and others that are earlier, and a replay.
        (f"{layout.bronze_tracking}/batch-q-0000000001", tracked(spark, 199_900, 200_400, 5)),
        (f"{layout.bronze_tracking}/batch-q-0000000002", tracked(spark, 100, 300, 0)),
        (f"{feeds_of_silver[1]}/batch-p-0000000000", tracked(spark, 0, 400, 1)),
        (f"{layout.bronze_tracking}/other-file", tracked(spark, 200_400, 200_500, 1)),
    ]
    whole = sum(path.stat().st_size for path in Path(layout.bronze_tracking).rglob("part-*"))
    for number, (path, rows_) in enumerate(batches):
        rows_.write.json(path)
        new = sum(part.stat().st_size for part in Path(path).rglob("part-*"))
        read = bytes_read(spark, f"take in {number}", lambda: pipeline.clean_tracking(spark, layout))
        # Heads of files may be looked at twice; nothing else is read.
        assert new <= read < 1.5 * new < whole / 10
        assert bytes_read(spark, f"nothing new {number}", lambda: pipeline.clean_tracking(spark, layout)) == 0
        full = Layout(layout.root, replays=["again"])
        Path(full.tracking_folders[1]).mkdir(parents=True, exist_ok=True)
        expected = silver.silver_tracking(bronze.read_bronze(spark, full.tracking_folders, schemas.BRONZE_TRACKING))
        assert bag(serving.read_current(spark, layout.silver_tracking)) == bag(expected)
    assert len(serving.deltas(spark, layout.silver_tracking)) == 4
    # A large batch folds the deltas into the files.
    tracked(spark, 150_000, 300_000, 2).write.json(f"{layout.bronze_tracking}/batch-q-0000000003")
    pipeline.clean_tracking(spark, layout)
    assert serving.deltas(spark, layout.silver_tracking) == []
    expected = silver.silver_tracking(bronze.read_bronze(spark, full.tracking_folders, schemas.BRONZE_TRACKING))
    assert bag(serving.read_current(spark, layout.silver_tracking)) == bag(expected)
    assert bytes_read(spark, "nothing new", lambda: pipeline.clean_tracking(spark, layout)) == 0


def test_an_incremental_run_that_died_takes_the_same_batches_again(spark, folder, monkeypatch):
    layout = Layout(folder("root"), incremental=True)
    tracked(spark, 0, 50_000, 1).write.json(f"{layout.bronze_tracking}/batch-q-0000000000")
    for number, step in enumerate(("_commit", "move")):
        with monkeypatch.context() as patched:
            patched.setattr(serving, step, lambda *args, **changes: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                pipeline.clean_tracking(spark, layout)
        pipeline.clean_tracking(spark, layout)
        assert len(serving.deltas(spark, layout.silver_tracking)) == number
        tracked(spark, 49_990, 50_020, 1).write.json(f"{layout.bronze_tracking}/batch-q-000000000{number + 1}")
    pipeline.clean_tracking(spark, layout)
    expected = silver.silver_tracking(bronze.read_bronze(spark, layout.bronze_tracking, schemas.BRONZE_TRACKING))
    assert bag(serving.read_current(spark, layout.silver_tracking)) == bag(expected)


def test_an_incremental_pipeline_gives_the_same_tables(spark, folder):
    plain, grown = Layout(folder("plain")), Layout(folder("grown"), incremental=True)
    for layout in (plain, grown):
        feed(spark, layout)
    pipeline.run(spark, plain.root)
    pipeline.run(spark, grown.root, incremental=True)
    for layout in (plain, grown):
        more = events(spark, ("3", "b", "Picked Up", "2026-05-02 00:00:00"), ("2", "a", "Delivered", "2026-05-12 00:00:00"))
        more.withColumn("event_timestamp", more.event_timestamp.cast("string")).write.mode("append").json(layout.bronze_tracking)
    expected = serving.fetch_all(spark, pipeline.run(spark, plain.root).serving)
    found = serving.fetch_all(spark, pipeline.run(spark, grown.root, incremental=True).serving)
    for name, df in expected.items():
        assert bag(found[name]) == bag(df), name
    with pytest.raises(ValueError, match="buckets"):
        Layout("x", buckets=4, incremental=True)
