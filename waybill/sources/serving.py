"""Serving tables: keyed loads into Parquet files under a manifest, reads by logical name.

A table is a folder of data folders, of delta folders, and of numbered manifests. A manifest
is one version of the table: its keys, the order in which late rows lose, and a line per file
with the range of its keys. Readers take the newest manifest, so they never see half a load, and
a load that died leaves files that no manifest names.

A load finds the files that hold any of its keys: those whose key range it meets, then, by a
join that reads key columns only, those that do hold one. Only they are written anew. It commits
by renaming its manifest to the number after the version it started from. Where another writer
was there first the load starts over from that version, so no load is lost.

Small batches of a stream are deltas: folders next to the data, which cost what the batch costs
and need no manifest. Readers lay them over the files, and `compact` folds them in. Files that
newer versions have no use for stay for readers of older ones: for the last `keep_versions`, and
for `GRACE_SECONDS` after they were replaced.

The driver holds a line per file, as it does for any scan's list of files; rows never pass it.
"""

import json
import re
import time
import uuid
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from waybill import fixed
from waybill.functions.parsing import quoted
from waybill.functions.rendering import json_safe
from waybill.operators.newest import newest_per_key
from waybill.sources.files import delete, exists, file_system, listed, move
from waybill.sources.tables import write_table

GRACE_SECONDS = 3600
#: Tables of so few files are written anew without asking which of them hold a key.
FEW_FILES = 4
ATTEMPTS = 20
_MANIFESTS = "_manifests"
_LEDGER = "_ledger.json"
_VERSION = re.compile(r"v(\d{10})\.json")
_DELTA = re.compile(r"delta-.+")
_PART = re.compile(r"part-.+")
_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Types whose values order in Python, as JSON, as they do in Spark.
_RANGED = (StringType, ByteType, ShortType, IntegerType, LongType, DateType, TimestampType, TimestampNTZType)


class Conflict(Exception):
    """Another writer has committed the version that a load wanted to be."""


# ---------------------------------------------------------------- files


def _read_text(spark, path):
    fs, file = file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark, path, text):
    fs, file = file_system(spark, path)
    stream = fs.create(file)
    stream.write(bytearray(text.encode()))
    stream.close()


def _create(spark, path, text):
    """Write a file that must not be there yet. It appears whole or not at all, and of several
    writers one succeeds, as far as the file system's rename sees to it."""
    staged = re.sub(r"[^/]+$", f".staged-{uuid.uuid4().hex}", path)
    _write_text(spark, staged, text)
    fs, file = file_system(spark, staged)
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        file.toUri() if file.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(file, spark._jvm.org.apache.hadoop.fs.Path(path), options)
    except Py4JJavaError as error:
        fs.delete(file, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise Conflict(path) from None
        raise


# ---------------------------------------------------------------- manifests


def _manifest_path(table_path, version):
    return f"{table_path.rstrip('/')}/{_MANIFESTS}/v{version:010d}.json"


def versions(spark, table_path):
    """Committed versions, oldest first."""
    names = listed(spark, f"{table_path.rstrip('/')}/{_MANIFESTS}", _VERSION)
    return [int(_VERSION.fullmatch(name).group(1)) for name in names]


def manifest(spark, table_path, version=None):
    """A version of a table, the newest without a number; None where there is no table.

    `keys` and `newest_by` as the table was made or last loaded with, `files` (path, low, high:
    the range of its keys, null where unknown), `folded`, the deltas that the files hold, and
    `ledger`, how far the files hold each source.
    """
    if version is None:
        known = versions(spark, table_path)
        if not known:
            return None
        version = known[-1]
    return json.loads(_read_text(spark, _manifest_path(table_path, version))) | {"version": version}


def _commit(spark, table_path, before, **changes):
    """Make `before` with `changes` the version after it."""
    after = {"keys": None, "newest_by": None, "files": [], "folded": [], "ledger": {}} | (before or {}) | changes
    version = (after.pop("version", None) or 0) + 1
    _create(spark, _manifest_path(table_path, version), json.dumps(after))
    return after | {"version": version}


def deltas(spark, table_path, version=None):
    """Paths of the committed deltas that the table's files do not hold yet."""
    root = table_path.rstrip("/")
    held = set((version or manifest(spark, root) or {"folded": []})["folded"])
    found = []
    for name in listed(spark, root, _DELTA):
        if name not in held and exists(spark, f"{root}/{name}/_SUCCESS"):
            found.append(f"{root}/{name}")
    return found


def _furthest(ledgers):
    """For each source the furthest place in any of the ledgers."""
    return {source: max(one[source] for one in ledgers if source in one) for source in set().union(*ledgers)}


def _delta_ledger(spark, delta):
    return json.loads(_read_text(spark, f"{delta}/{_LEDGER}")) if exists(spark, f"{delta}/{_LEDGER}") else {}


def ledger(spark, table_path):
    """How far the table holds each source that its loads and batches have named."""
    now = manifest(spark, table_path)
    waiting = [_delta_ledger(spark, delta) for delta in deltas(spark, table_path, now)]
    return _furthest([(now or {}).get("ledger", {}), *waiting])


# ---------------------------------------------------------------- reading


def _all_of(spark, paths):
    return spark.read.parquet(*paths)


def _united(parts):
    return reduce(lambda left, right: left.unionByName(right), parts)


def matched(rows, others, keys, how):
    """The rows with (left_semi) or without (left_anti) a key in `others`; null keys match."""
    others = others.select(*map(quoted, keys)).alias("others")
    rows = rows.alias("rows")
    same = reduce(and_, [rows[key].eqNullSafe(others[key]) for key in keys])
    return rows.join(others, same, how)


def _overlaid(spark, base, waiting, keys, newest_by):
    """Files with deltas over them: of all rows for a key the newest stays. Only the rows of the
    deltas' keys are reduced; the others pass, without a shuffle where the deltas are small."""
    late = _united([spark.read.parquet(path) for path in waiting])
    if not base:
        return newest_per_key(late, keys, newest_by)
    rows = _all_of(spark, base)
    changed = newest_per_key(matched(rows, late, keys, "left_semi").unionByName(late), keys, newest_by)
    return matched(rows, late, keys, "left_anti").unionByName(changed)


def read_current(spark, table_path, keys=None, newest_by=None):
    """The rows of a table as of its newest version and the deltas next to it. The table knows
    its keys and order; naming them here reads it under others."""
    now = manifest(spark, table_path)
    waiting = deltas(spark, table_path, now)
    if not now or not (now["files"] or waiting):
        raise ValueError(f"no table at {table_path}")
    root = table_path.rstrip("/")
    base = [f"{root}/{file['path']}" for file in now["files"]]
    if not waiting:
        return _all_of(spark, base)
    return _overlaid(spark, base, waiting, keys or now["keys"], newest_by or now["newest_by"] or ())


# ---------------------------------------------------------------- loading


def merged(current, new, keys):
    """`new` on top of `current`: rows with an equal key give way. Null keys equal each other."""
    incoming = new.select(*keys).alias("incoming")
    held = current.alias("held")
    same_key = reduce(and_, [held[key].eqNullSafe(incoming[key]) for key in keys])
    return held.join(incoming, same_key, "left_anti").unionByName(new)


def _ranged(df, keys):
    return all(isinstance(df.schema[key].dataType, _RANGED) for key in keys)


def _key_range(keys):
    """Columns `low` and `high`: the smallest and the greatest key as JSON."""
    key = F.struct(*[quoted(name) for name in keys])
    written = {"ignoreNullFields": "false", "timestampFormat": _INSTANT, "timestampNTZFormat": _INSTANT}
    return F.to_json(F.min(key), written).alias("low"), F.to_json(F.max(key), written).alias("high")


def _place(text, keys):
    """A key from JSON in the order of Spark: null below every value."""
    values = json.loads(text)
    return [(values[key] is not None, values[key]) if values[key] is not None else (False,) for key in keys]


def files_met(files, low, high, keys):
    """The files whose key range meets the one from `low` to `high`; unknown ranges meet all."""
    first, last = _place(low, keys), _place(high, keys)
    return [
        file
        for file in files
        if file["low"] is None or (_place(file["high"], keys) >= first and _place(file["low"], keys) <= last)
    ]


def _files_hit(spark, root, files, new, keys):
    """The files that hold a key of `new`; others need not be written anew."""
    if len(files) <= FEW_FILES:
        return files
    if _ranged(new, keys):
        low, high = new.agg(*_key_range(keys)).first()
        files = files_met(files, low, high, keys) if low is not None else []
    if not files:
        return []
    held = _all_of(spark, [f"{root}/{file['path']}" for file in files])
    held = held.select(*map(quoted, keys), F.col("_metadata.file_path").alias("__file"))
    hit = matched(held, new, keys, "left_semi").select("__file").distinct().collect()
    names = {"/".join(row[0].split("/")[-2:]) for row in hit}
    return [file for file in files if file["path"] in names]


def _written(spark, root, rows, keys, partitions, sort_by):
    """Write rows to a new data folder whose files have a narrow range of keys each; their
    manifest lines."""
    folder = f"data-{uuid.uuid4().hex}"
    columns = [quoted(key) for key in keys]
    rows = rows.repartitionByRange(*([partitions] if partitions else []), *columns)
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    write_table(rows, f"{root}/{folder}")
    names = listed(spark, f"{root}/{folder}", _PART)
    files = {name: {"path": f"{folder}/{name}", "low": None, "high": None} for name in names}
    if len(files) > FEW_FILES and _ranged(rows, keys):
        stored = spark.read.parquet(f"{root}/{folder}")
        name = F.col("_metadata.file_name").alias("__name")
        found = stored.select(*columns, name).groupBy("__name").agg(*_key_range(keys))
        for row in found.collect():
            files[row["__name"]] |= {"low": row["low"], "high": row["high"]}
    return folder, list(files.values())


def _load(spark, table_path, make, keys, newest_by, partitions, sort_by, reached):
    """Commit a version that `make(version, waiting)` gives (files to replace, rows) for."""
    root = table_path.rstrip("/")
    for _ in range(ATTEMPTS):
        now = manifest(spark, root)
        waiting = deltas(spark, root, now)
        replaced, rows = make(now, waiting)
        folder, files = _written(spark, root, rows, keys, partitions, sort_by)
        gone = {file["path"] for file in replaced}
        there = set(listed(spark, root, _DELTA))
        folded = [name for name in (now or {"folded": []})["folded"] if name in there]
        try:
            return _commit(
                spark,
                root,
                now,
                keys=list(keys),
                newest_by=list(newest_by) if newest_by is not None else (now or {}).get("newest_by"),
                files=[file for file in (now or {"files": []})["files"] if file["path"] not in gone] + files,
                folded=folded + [path.rsplit("/", 1)[1] for path in waiting],
                ledger=_furthest([(now or {}).get("ledger", {}), *[_delta_ledger(spark, one) for one in waiting], reached]),
            )
        except Conflict:
            delete(spark, f"{root}/{folder}")
    raise Conflict(f"{table_path}: {ATTEMPTS} loads in a row were overtaken")


def upsert(
    spark,
    new,
    table_path,
    keys,
    partitions=None,
    newest_by=None,
    sort_by=(),
    keep_versions=2,
    unique=False,
    grace_seconds=GRACE_SECONDS,
    reached=None,
):
    """Merge rows into a table by key, and make the result its next version.

    Incoming rows replace stored ones; of several for a key the greatest stays, unless the
    caller vouches that keys are `unique`. With `newest_by`, rows may arrive late: of all
    rows for a key, stored or incoming, the newest stays. Deltas are folded in on the way.

    Rows are spread by key range over as many files as adaptive execution or `partitions`
    asks for, so that later loads meet few of them. `sort_by` orders rows within each file, so
    that reads which filter on these columns skip pages. Repeating an upsert changes nothing.
    `reached` goes to the table's ledger with the rows: how far they hold each source.
    """
    root = table_path.rstrip("/")

    def make(now, waiting):
        files = now["files"] if now else []
        order = newest_by if newest_by is not None else (now or {}).get("newest_by") or ()
        late = [spark.read.parquet(path) for path in waiting]
        asked = _united([part.select(*map(quoted, keys)) for part in [new, *late]])
        hit = _files_hit(spark, root, files, asked, keys)
        held = [_all_of(spark, [f"{root}/{file['path']}" for file in hit])] if hit else []
        if newest_by is not None:
            return hit, newest_per_key(_united([new, *late, *held]), keys, newest_by)
        rows = new if unique else newest_per_key(new, keys)
        if late:
            held = [newest_per_key(_united([*late, *held]), keys, order)]
        return hit, merged(held[0], rows, keys) if held else rows

    _load(spark, root, make, keys, newest_by, partitions, sort_by, reached or {})
    expire(spark, root, keep_versions, grace_seconds)


def expire(spark, table_path, keep_versions=2, grace_seconds=GRACE_SECONDS):
    """Drop versions before the last `keep_versions` that were replaced more than
    `grace_seconds` ago, with the files and deltas that only they have a use for."""
    root = table_path.rstrip("/")
    statuses = list(listed(spark, f"{root}/{_MANIFESTS}", _VERSION).items())
    since = (time.time() - grace_seconds) * 1000
    old = [
        name
        for (name, _), (_, after) in zip(statuses, statuses[1:], strict=False)
        if after.getModificationTime() <= since
    ]
    old = [name for name in old if name not in {name for name, _ in statuses[-max(keep_versions, 1) :]}]
    if not old:
        return
    read = {name: manifest(spark, root, int(_VERSION.fullmatch(name).group(1))) for name, _ in statuses}
    kept = [read[name] for name in read if name not in old]
    used = {file["path"] for one in kept for file in one["files"]}
    unused = {file["path"] for name in old for file in read[name]["files"]} - used
    folders = {path.split("/")[0] for path in unused} - {path.split("/")[0] for path in used}
    loose = [path for path in unused if path.split("/")[0] not in folders]
    # A delta that the oldest kept version holds in its files, no reader asks for any more.
    folded = set(kept[0]["folded"])
    delete(spark, *[f"{root}/{path}" for path in [*folders, *loose, *folded]])
    delete(spark, *[f"{root}/{_MANIFESTS}/{name}" for name in old])


def declare(spark, table_path, keys, newest_by):
    """See to it that a table is there and knows its keys and order, so that it can take deltas."""
    for _ in range(ATTEMPTS):
        now = manifest(spark, table_path)
        wanted = {"keys": list(keys), "newest_by": list(newest_by)}
        if now and {name: now[name] for name in wanted} == wanted:
            return
        try:
            _commit(spark, table_path, now, **wanted)
            return
        except Conflict:
            continue
    raise Conflict(table_path)


def append_delta(batch, table_path, keys, newest_by, name, reached=None):
    """Put a batch next to the table's files, where it appears whole. A batch that has landed
    already is left as it is: the same `name` is the same batch, run again. `reached` goes to
    the ledger with it."""
    spark, root = batch.sparkSession, table_path.rstrip("/")
    declare(spark, root, keys, newest_by)
    if exists(spark, f"{root}/delta-{name}/_SUCCESS"):
        return
    staged = f"{root}/_staged/delta-{name}"
    write_table(newest_per_key(batch, keys, newest_by), staged)
    if reached:
        _write_text(spark, f"{staged}/{_LEDGER}", json.dumps(reached))
    move(spark, staged, f"{root}/delta-{name}")


def compact(spark, table_path, keys=None, newest_by=None, **upsert_options):
    """Fold the deltas into the files that hold their keys. They stay on disk for the readers of
    the version before, like its files."""
    now = manifest(spark, table_path)
    waiting = deltas(spark, table_path, now)
    if waiting:
        keys, newest_by = keys or now["keys"], newest_by or now["newest_by"]
        empty = spark.read.parquet(waiting[0]).limit(0)
        upsert(spark, empty, table_path, keys, newest_by=newest_by, **upsert_options)


def upsert_stream(stream, table_path, keys, checkpoint, newest_by, trigger=None):
    """Upsert every micro-batch as a delta, whatever order the rows arrive in.

    A batch that is run again after a failure lands once. `compact` the table from time to time.
    """

    def load(batch, batch_id):
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_delta(batch, table_path, keys, newest_by, f"{query}-{batch_id:010d}")

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# ---------------------------------------------------------------- by name


def fetch(spark, root, name):
    """A serving table by its logical name, with what streams have put next to it."""
    if name not in fixed.SERVING_TABLES:
        raise ValueError(f"unknown table '{name}', valid names: {', '.join(fixed.SERVING_TABLES)}")
    return read_current(spark, f"{root.rstrip('/')}/{fixed.SERVING_TABLES[name]}")


def fetch_all(spark, root):
    return {name: fetch(spark, root, name) for name in fixed.SERVING_TABLES}


def fetch_json_safe(spark, root):
    """The bundle of all tables with dates and timestamps as ISO-8601 text."""
    return {name: json_safe(df) for name, df in fetch_all(spark, root).items()}
