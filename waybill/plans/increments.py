"""Silver from what has landed in bronze since the last run.

A silver table is a keyed table (`sources.serving`) whose ledger says how far it holds bronze.
The ledger is committed with the rows, so a run that died takes up the same batches again, and
one that has nothing new does nothing. Of several rows for a key the newest stays, whichever run
brought it: late rows and replays lose against what is there, and the table is the one that a
run over all of bronze gives.

A run reads what is new and nothing else, and puts it next to the table as a delta. When the
deltas have grown to `FOLD_SHARE` of the files, the run folds them in instead.

With a folder for `changes`, a run also notes what it changes: the rows that the table had for the
new keys, with sign -1, and those that it has from now on, with sign 1. That reads the table
too. `plans.route_changes` follows them.
"""

import hashlib

from pyspark.sql import functions as F

from waybill import schemas
from waybill.functions.parsing import quoted
from waybill.operators.newest import newest_per_key
from waybill.plans import silver
from waybill.session import shuffles_sized_for, stored_bytes, work_dir
from waybill.sources import serving
from waybill.sources.bronze import landed_since, read_bronze
from waybill.sources.files import delete
from waybill.sources.tables import read_table, write_table

FOLD_SHARE = 0.2

SHIPMENTS = (schemas.BRONZE_SHIPMENTS, silver.known_shipments, ["shipment_id"], ["shipping_date"])
TRACKING = (schemas.BRONZE_TRACKING, silver.dated_tracking, ["event_id"], ["event_timestamp"])


def _bytes_of_files(spark, table_path):
    now = serving.manifest(spark, table_path) or {"files": []}
    folders = {file["path"].split("/")[0] for file in now["files"]}
    return stored_bytes(spark, *[f"{table_path}/{folder}" for folder in folders])


def changed_rows(spark, table_path, batch, keys, newest_by):
    """What a table's rows become when a batch with one row per key is taken in: (row, sign),
    without the rows that stay as they are."""
    if serving.manifest(spark, table_path) is None:
        return batch.withColumn("sign", F.lit(1))
    before = serving.matched(serving.read_current(spark, table_path), batch, keys, "left_semi")
    after = newest_per_key(before.unionByName(batch), keys, newest_by)
    both = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))
    return both.groupBy(*map(quoted, batch.columns)).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")


def take_in(spark, folders, table_path, feed, fold_share=FOLD_SHARE, changes=None):
    """Bring a silver table up to what has landed in the bronze `folders`; the number of batches
    and files that were new. With `changes`, what changes is noted there before it does: a run
    that died in between notes the same again."""
    schema, clean, keys, newest_by = feed
    known = serving.ledger(spark, table_path)
    new, reached = landed_since(spark, folders, known)
    if not new:
        return 0
    with shuffles_sized_for(spark, *new):
        # Read several times below, so bronze is taken apart, and its keys are reduced, once.
        path = work_dir(spark, "taken-in")
        write_table(newest_per_key(clean(read_bronze(spark, new, schema)), keys, newest_by), path)
        rows = read_table(spark, path)
        # Named by what it holds: the same batches, taken in again, are the same delta.
        name = hashlib.sha256("\n".join(new).encode()).hexdigest()[:32]
        if changes:
            reached[changes] = known.get(changes, -1) + 1
            noted = f"{changes}/batch-changes-{reached[changes]:010d}"
            write_table(changed_rows(spark, table_path, rows, keys, newest_by), noted)
        files = _bytes_of_files(spark, table_path)
        waiting = stored_bytes(spark, *serving.deltas(spark, table_path))
        if waiting + stored_bytes(spark, *new) > fold_share * files:
            serving.upsert(spark, rows, table_path, keys, newest_by=newest_by, reached=reached)
        else:
            serving.append_delta(rows, table_path, keys, newest_by, name, reached)
    delete(spark, path)
    return len(new)


def take_in_shipments(spark, layout):
    return take_in(spark, layout.shipment_folders, layout.silver_shipments, SHIPMENTS, changes=layout.shipment_changes)


def take_in_tracking(spark, layout):
    return take_in(spark, layout.tracking_folders, layout.silver_tracking, TRACKING, changes=layout.tracking_changes)
