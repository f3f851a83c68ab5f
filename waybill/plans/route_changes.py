"""Route metrics from what has changed in silver.

The metrics are sums over events joined with their shipments, R = C * S, where C counts the events
of each shipment at each location. When both change,

    R' - R = dC * S' + (C' - dC) * dS

with the new tables and the signed changes: every event that came or went counts under its
shipment's new route, weight and value, and the events of a changed shipment that were there before
are taken back under the old ones and added under the new ones. So a run reads the
changes, the shipments of changed events and the events of changed shipments.

The sums are a keyed table, whose ledger says which changes it holds; a run that died takes up the
same changes again. They are decimals, which give back exactly what they took, so no error builds
up however often rows change.
"""

from functools import reduce

from pyspark.sql import functions as F

from waybill.functions.parsing import quoted
from waybill.plans import gold
from waybill.session import shuffles_sized_for, work_dir
from waybill.sources import serving
from waybill.sources.bronze import landed_since
from waybill.sources.files import delete
from waybill.sources.serving import matched
from waybill.sources.tables import read_table, write_table

KEYS = ["origin", "destination", "location"]
#: Amounts up to 10 ** 22 to the millionth, and sums of up to 10 ** 10 of them.
AMOUNT, TOTAL = "decimal(28,6)", "decimal(38,6)"
#: Events, and those whose shipment has a value or a weight.
SUMS = {"events": "long", "value": TOTAL, "valued": "long", "weight": TOTAL, "weighed": "long"}


def amounts(shipments, *more):
    """Shipments with exact amounts, null where there is none."""
    return shipments.select(
        "shipment_id",
        "origin",
        "destination",
        F.col("declared_value").try_cast(AMOUNT).alias("amount"),
        F.col("weight_kg").try_cast(AMOUNT).alias("kg"),
        *more,
    )


def sums_of(counts, exact):
    """Sums by route and location of `counts` (shipment_id, location, events) and of shipments
    with `amounts`, of which there may be several signed ones."""
    n = F.col("events") * F.col("sign") if "sign" in exact.columns else F.col("events")
    terms = {
        "events": n,
        "value": F.col("amount") * n,
        "valued": F.when(F.col("amount").isNotNull(), n),
        "weight": F.col("kg") * n,
        "weighed": F.when(F.col("kg").isNotNull(), n),
    }
    rows = counts.join(exact, "shipment_id")
    return added([rows.select(*KEYS, *[terms[name].cast(kind).alias(name) for name, kind in SUMS.items()])])


def added(parts):
    """Sums of terms or of sums, combined on the map side."""
    rows = reduce(lambda left, right: left.unionByName(right), parts)
    sums = [F.coalesce(F.sum(name), F.lit(0)).cast(kind).alias(name) for name, kind in SUMS.items()]
    return rows.groupBy(*KEYS).agg(*sums)


def summed(changes, columns):
    """Signed rows without those that came and went."""
    return changes.groupBy(*map(quoted, columns)).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def changed_sums(tracking, shipments, tracking_changes, shipment_changes):
    """What the sums change by, from the new tables and the signed changes of each."""
    came = summed(tracking_changes, ["shipment_id", "location"]).withColumnRenamed("sign", "events")
    turned = amounts(summed(shipment_changes, shipments.columns), "sign")
    there = gold.event_counts(matched(tracking, turned, ["shipment_id"], "left_semi"))
    before = there.unionByName(came.withColumn("events", -F.col("events")))
    before = before.groupBy("shipment_id", "location").agg(F.sum("events").alias("events"))
    return added([sums_of(came, amounts(shipments)), sums_of(before, turned)])


def routes_from(sums):
    """Route metrics as `gold.route_optimization` has them."""
    value, weight = F.col("value").cast("double"), F.col("weight").cast("double")
    return sums.where("events <> 0").select(
        *KEYS,
        F.col("events").alias("total_shipments"),
        F.when(F.col("valued") != 0, value).alias("total_value_at_risk"),
        F.when(F.col("weighed") != 0, weight / F.col("weighed")).alias("avg_weight_kg"),
    )


def follow(spark, layout):
    """Bring the sums up to the silver tables; the number of changes that were new."""
    tables = layout.silver_tracking, layout.silver_shipments
    folders = layout.tracking_changes, layout.shipment_changes
    if any(serving.manifest(spark, table) is None for table in tables):
        return 0
    known = serving.ledger(spark, layout.route_sums)
    found = [landed_since(spark, folder, known) for folder in folders]
    if not any(new for new, _ in found):
        return 0
    tracking, shipments = [serving.read_current(spark, table) for table in tables]
    signed = [
        spark.read.parquet(*new) if new else df.limit(0).withColumn("sign", F.lit(1))
        for (new, _), df in zip(found, (tracking, shipments), strict=True)
    ]
    with shuffles_sized_for(spark, *[path for new, _ in found for path in new]):
        # Read twice below: once to find what it adds to, once to add it.
        path = work_dir(spark, "changed-sums")
        write_table(changed_sums(tracking, shipments, *signed), path)
        rows = read_table(spark, path)
        if serving.manifest(spark, layout.route_sums):
            held = serving.read_current(spark, layout.route_sums)
            rows = added([rows, matched(held, rows, KEYS, "left_semi")])
        reached = {source: place for _, one in found for source, place in one.items()}
        serving.upsert(spark, rows, layout.route_sums, KEYS, unique=True, reached=reached)
    delete(spark, path, *[one for new, _ in found for one in new])
    return sum(len(new) for new, _ in found)
