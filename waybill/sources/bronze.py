"""Bronze: messages as they came, one JSON object a line, append-only.

Nothing is projected on the way in: a message keeps fields that no schema knows yet. Line breaks
between the tokens of a message become spaces; a message of one whole object a line keeps its
lines, and one of several objects that are themselves broken over lines is no JSON object. Values
that are not JSON objects go to a folder of their own. Schemas apply on reading, and one
definition of a sound line (`topic.from_messages`) serves all readers.
"""

import re
import time
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.session import stored_bytes
from waybill.sources import topic
from waybill.sources.files import delete, exists, listed, make_folder, move


PACKED_BYTES = 256 * 1024 * 1024
GRACE_SECONDS = 3600


def _paths(path):
    return [path] if isinstance(path, str) else list(path)


def _lines(reader, path):
    # Batches are folders below; those of other writers are files directly in the folder.
    return reader.option("recursiveFileLookup", True).text(path)


def read_bronze(spark, path, schema):
    """The lines that are JSON objects, under an explicit schema. `path` may be a list of
    folders, for instance of a feed and of its replay."""
    places = [place for one in _paths(path) for place in current(spark, one)]
    return topic.from_messages(_lines(spark.read, places), schema)


_BATCH = re.compile(r"(batch-.+)-(\d{10})")
_PACKED = re.compile(r"packed-(batch-.+)-(\d{10})-(\d{10})")
_SEEN = re.compile(r"[^_.].*")


def _listing(spark, path):
    """Names in a bronze folder: those that readers take, and those that a packed one holds."""
    names = list(listed(spark, path, _SEEN))
    spans = {name: (found[1], int(found[2]), int(found[3])) for name in names if (found := _PACKED.fullmatch(name))}
    for name in names:
        if name not in spans and (found := _BATCH.fullmatch(name)):
            spans[name] = found[1], int(found[2]), int(found[2])
    packed = [name for name in names if _PACKED.fullmatch(name)]
    gone = {name for name in spans if any(_holds(spans, one, name) for one in packed)}
    return [name for name in names if name not in gone], sorted(gone), spans


def _holds(spans, one, name):
    (query, low, high), (own, first, last) = spans[one], spans[name]
    return one != name and query == own and low <= first and last <= high


def current(spark, path):
    """The paths to read of a bronze folder: itself, or what is in it where batches were packed."""
    root = path.rstrip("/")
    names, gone, _ = _listing(spark, root)
    return [f"{root}/{name}" for name in names] if gone else [path]


def pack(spark, path, target_bytes=PACKED_BYTES, grace_seconds=GRACE_SECONDS):
    """Merge the folders of consecutive batches of a query into folders of about `target_bytes`;
    the number of folders that were merged.

    The newest batch of a query, which may be run again, is left alone. A packed folder appears
    whole and names the batches it holds, which readers pass over from then on; the batches'
    own folders stay for `grace_seconds`, for readers that have listed them before. Readers with a
    ledger take a packed folder for its last batch. A stream that follows the folder sees the lines
    of a packed folder again, as after a replay.
    """
    root = path.rstrip("/")
    names, gone, spans = _listing(spark, root)
    statuses = listed(spark, root, _SEEN)
    since = (time.time() - grace_seconds) * 1000
    after = {name: min(statuses[one].getModificationTime() for one in names if one in spans and _holds(spans, one, name)) for name in gone}
    delete(spark, *[f"{root}/{name}" for name in gone if after[name] <= since])
    queries, merged = {}, 0
    for name in names:
        if name in spans:
            queries.setdefault(spans[name][0], []).append(name)
    for query, own in queries.items():
        own.sort(key=lambda name: spans[name][1])
        bins, size = [[]], 0
        for name in own[:-1]:
            held = stored_bytes(spark, f"{root}/{name}")
            if bins[-1] and size + held > target_bytes:
                bins.append([])
                size = 0
            bins[-1].append(name)
            size += held
        for some in bins:
            if len(some) > 1:
                low, high = spans[some[0]][1], spans[some[-1]][2]
                target = f"packed-{query}-{low:010d}-{high:010d}"
                rows = _lines(spark.read, [f"{root}/{name}" for name in some])
                # A bin is a file's worth or a little more, however many files it comes from.
                rows.coalesce(1).write.mode("overwrite").text(f"{root}/_staged/{target}")
                move(spark, f"{root}/_staged/{target}", f"{root}/{target}")
                merged += len(some)
    return merged


def landed_since(spark, path, ledger):
    """What has landed in bronze and `ledger` does not hold yet: its folders and files, and how
    far the ledger reaches with them. Of each query the ledger has the last batch, as they land
    one after another; of other writers, each file."""
    new, reached = [], {}
    for folder in _paths(path):
        root = folder.rstrip("/")
        names, _, spans = _listing(spark, root)
        for name in names:
            query, _, last = spans.get(name, (name, 0, 0))
            source, place = f"{root}/{query}", last
            if place > ledger.get(source, -1):
                new.append(f"{root}/{name}")
                reached[source] = max(place, reached.get(source, -1))
    return new, reached


def broken_lines(spark, path):
    """The lines `read_bronze` leaves out, with the file that holds them."""
    lines = _lines(spark.read, current(spark, path)).select("value", F.col("_metadata.file_path").alias("file"))
    return topic.rejected(lines.filter(F.trim("value") != "")).withColumnRenamed("value", "line")


def stream_bronze(spark, path, schema, **options):
    return topic.from_messages(_lines(spark.readStream.options(**options), path), schema)


def rejects_of(path):
    """Where the values go that bronze at `path` does not take."""
    return f"{path.rstrip('/')}-rejects"


def _lined(value):
    """A sound value as text that is read line by line; null where that would lose a part."""
    # In sound JSON, a line break stands between tokens only.
    single = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    each = F.forall(
        F.split(value, r"[\r\n]+"),
        lambda line: (F.trim(line) == "") | (F.trim(line).startswith("{") & F.get_json_object(line, "$").isNotNull()),
    )
    return (
        F.when(~value.rlike(r"[\r\n]"), value)
        .when(single, F.regexp_replace(value, r"[\r\n]", " "))
        .when(each, value)
    )


SOUND, ASIDE = "sound", "aside"


def _sorted_out(batch):
    """(value, kind): sound values as lines, the others as lines of the rejects, where one with
    line breaks is a backslash and a JSON object, like one that begins with a backslash, so that
    `read_rejects` can tell them. Null values have no text to keep."""
    value = F.col("value")
    rows = topic.judged(batch).select("value", F.when(F.col("sound"), _lined(value)).alias("lined"))
    escaped = F.concat(F.lit("\\"), F.to_json(F.struct("value")))
    aside = F.when(value.rlike(r"[\r\n]|^\\"), escaped).otherwise(value)
    kind = F.when(F.col("lined").isNotNull(), SOUND).otherwise(ASIDE)
    return rows.where("value IS NOT NULL").select(F.coalesce("lined", aside).alias("value"), kind.alias("kind"))


def _staged(batch, path, name, max_records_per_file=None):
    """Write the values of a batch, sorted out, where no reader looks. One pass over the batch."""
    staged = f"{path.rstrip('/')}/_staged/{name}"
    writer = _sorted_out(batch).write.mode("overwrite").partitionBy("kind")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.text(staged)
    return {kind: f"{staged}/kind={kind}" for kind in (SOUND, ASIDE)}


def _settle(spark, source, folder, name):
    """Let staged values appear in `folder`, if there are any."""
    make_folder(spark, folder)
    if exists(spark, source):
        move(spark, source, f"{folder.rstrip('/')}/{name}")


def _name(batch, batch_id):
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id:010d}"


def read_rejects(spark, path):
    """The values that bronze at `path` did not take, as they came."""
    line = F.col("value")
    whole = F.from_json(F.substr(line, F.lit(2)), "value string")["value"]
    make_folder(spark, rejects_of(path))
    lines = _lines(spark.read, rejects_of(path))
    return lines.select(F.when(line.startswith("\\"), whole).otherwise(line).alias("value"))


def append_bronze(messages, path, checkpoint, trigger=None, max_records_per_file=None):
    """Append the values of a stream to bronze, each exactly once across restarts, and those
    that are not JSON objects to `rejects_of(path)`.

    A micro-batch writes folders of its own, named by the query and the batch. One that is run
    again after a failure replaces them, and another query never does.
    """

    def land(batch, batch_id):
        spark, name = batch.sparkSession, f"batch-{_name(batch, batch_id)}"
        staged = _staged(batch, path, name, max_records_per_file)
        _settle(spark, staged[SOUND], path, name)
        _settle(spark, staged[ASIDE], rejects_of(path), name)
        delete(spark, f"{path.rstrip('/')}/_staged/{name}")

    writer = messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def declared_sink(messages, path, checkpoint, flush_records, flush_interval=None, poll="1 second"):
    """Bronze sink that flushes at a number of records or after an interval, whichever is first.

    A flush writes files of exactly `flush_records`; fewer wait, for more or until the first of
    them has waited for `flush_interval`, and then land as they are. Values that are not JSON
    objects don't count and land aside at once. Without an interval the query drains what is
    there, in files of at most that many records, and ends.

    `fixed.SINK_FLUSH_RECORDS` and `fixed.SINK_FLUSH_INTERVAL` are the bounds of a trickle; choose
    more records with the feed's rate: fewer than one flush wait, however large the feed. A
    topic of Kafka needs no waiting room: see `flush_options`.
    """
    if not flush_interval:
        return append_bronze(messages, path, checkpoint, max_records_per_file=flush_records)
    spark = messages.sparkSession
    wait = spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {flush_interval})").first()[0]
    value, tick = F.col("value").cast("string").alias("value"), F.lit(True).alias("tick")
    # A trigger without new messages runs no batch; the ticks see to it that time goes on.
    ticks = spark.readStream.format("rate").load().select(F.lit(None).cast("string").alias("value"), tick)
    stream = messages.select(value, F.lit(False).alias("tick")).unionByName(ticks)

    def land(batch, batch_id):
        flush(batch.where("NOT tick").select("value"), batch_id, path, flush_records, wait)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=poll).start()


def flush_options(flush_records, flush_interval):
    """Options of a Kafka source that start a micro-batch at so many records or after an
    interval, whichever is first; with `append_bronze(..., max_records_per_file=flush_records)`."""
    return {"minOffsetsPerTrigger": flush_records, "maxTriggerDelay": flush_interval}


_WAITING = re.compile(r"(?P<name>(?P<query>.+)-(?P<batch>\d{10}))-since-(?P<since>\d+)")


def flush(batch, batch_id, path, flush_records, wait):
    """Land a micro-batch and what waits from before, as far as it makes up whole flushes, or
    all of it once the first of what waits has waited for `wait` milliseconds.

    What waits, fewer records than a flush has, is a folder that names the batch which left it and
    the time of its first record. A folder goes when a later batch finds the next one: a
    batch that is run again after a failure then finds what it has found before.
    """
    spark, root, name = batch.sparkSession, path.rstrip("/"), _name(batch, batch_id)
    make_folder(spark, root)
    staged = _staged(batch, root, name)
    _settle(spark, staged[ASIDE], rejects_of(path), f"batch-{name}")
    query, now = name[:-11], int(time.time() * 1000)
    folders = [_WAITING.fullmatch(folder) for folder in listed(spark, f"{root}/_waiting", _WAITING)]
    left = [found for found in folders if found["query"] == query and int(found["batch"]) < batch_id]
    delete(spark, *[f"{root}/_waiting/{found.group()}" for found in left[:-1]])
    last, since = (left[-1], int(left[-1]["since"])) if left else (None, now)
    # What has waited comes first, and is less than a flush.
    sources = [f"{root}/_waiting/{last.group()}"] if last else []
    new = exists(spark, staged[SOUND])
    sources += [staged[SOUND]] if new else []
    parts = [spark.read.text(source).select("value") for source in sources]
    sizes = [part.count() for part in parts]
    since = now if last and not sizes[0] else since
    n = sum(sizes)
    ready = n if now - since >= wait else n - n % flush_records
    if new or ready:
        rows = numbered(reduce(lambda one, other: one.union(other), parts))
        rows = rows.withColumn("flush", F.floor(F.col("number") / flush_records))
        if ready:
            done = rows.where(F.col("number") < ready).repartition("flush").sortWithinPartitions("flush")
            writer = done.select("value").write.mode("overwrite").option("maxRecordsPerFile", flush_records)
            writer.text(f"{root}/_staged/{name}-done")
            move(spark, f"{root}/_staged/{name}-done", f"{root}/batch-{name}")
        rest = rows.where(F.col("number") >= ready).select("value").coalesce(1)
        rest.write.mode("overwrite").text(f"{root}/_staged/{name}-rest")
        delete(spark, *[f"{root}/_waiting/{found.group()}" for found in folders if found["name"] == name])
        move(spark, f"{root}/_staged/{name}-rest", f"{root}/_waiting/{name}-since-{now if ready else since}")
    delete(spark, f"{root}/_staged/{name}")


def numbered(rows):
    """`rows`, which are in files, with a gapless `number` from 0 on: the place within a partition
    and the rows of the partitions before it, of which there is a row each."""
    placed = rows.withColumn("id", F.monotonically_increasing_id())
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    rows = placed.withColumn("part", part).join(starts, "part")
    return rows.select("value", (F.col("start") + place).alias("number"))
