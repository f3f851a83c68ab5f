"""The report's numbers from one table of aggregates.

The cube has a row per origin, destination and delay, and per status, day, bin of durations or
location, with counts and sums that add up over any selection. It is made once after a load,
in one pass over each gold table besides the ranges of durations, and a change of a slicer then
reads it instead of them. Its size follows the number of places, days and locations, not of
shipments.

Durations are kept in bins of a power of ten, at least two hundred to the range of each origin,
destination and delay. Any histogram over a selection has bins at least ten times as wide, whose
edges are edges of those, so it is exact; a single duration is kept as it is.
"""

from functools import reduce

from pyspark.sql import functions as F

from waybill import fixed
from waybill.functions.measures import is_open, known_delay, outcome, route_label
from waybill.operators.histogram import bin_index, bin_width
from waybill.operators.kpis import kpi_cards
from waybill.operators.ranking import for_display, largest
from waybill.operators.slicers import Selection, narrow_all, slicer_values
from waybill.plans.report import settled

PLACES = ["origin", "destination"]
STATUS, DAY, DURATION, LOCATION = "status", "day", "duration", "location"
FINEST_BINS = 200
COLUMNS = {
    "kind": "string",
    "origin": "string",
    "destination": "string",
    "is_delayed": "boolean",
    "label": "string",
    "day": "date",
    "low": "double",
    "high": "double",
    "num": "double",
    "den": "double",
    "bin": "long",
    "n": "long",
    "amount": "double",
}


def _shaped(rows, kind):
    rows = rows.withColumn("kind", F.lit(kind))
    return rows.select(
        *[
            (F.col(name) if name in rows.columns else F.lit(None)).cast(of).alias(name)
            for name, of in COLUMNS.items()
        ]
    )


def _performance_parts(performance):
    """Counts by day and by bin of durations, from one pass with grouping sets."""
    keys = [*PLACES, "is_delayed"]
    value = F.col("delivery_duration_days").cast("double")
    rows = performance.select(*keys, F.col("shipping_date").alias("day"), value.alias("value"))
    ranges = rows.groupBy(*keys).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    exponent = F.floor(F.log10((F.col("high") - F.col("low")) / F.lit(FINEST_BINS)))
    spread = F.col("high") > F.col("low")
    ranges = ranges.withColumns(
        {
            "num": F.when(spread, F.pow(F.lit(10.0), F.greatest(exponent, F.lit(0)))),
            "den": F.when(spread, F.pow(F.lit(10.0), F.greatest(-exponent, F.lit(0)))),
        }
    )
    other = ranges.withColumnsRenamed({name: f"of_{name}" for name in keys})
    same = reduce(lambda a, b: a & b, [rows[name].eqNullSafe(other[f"of_{name}"]) for name in keys])
    rows = rows.join(other, same).drop(*[f"of_{name}" for name in keys])
    rows = rows.withColumn("bin", bin_index(F.col("value"), {"num": F.col("num"), "den": F.col("den")}))
    cell = ["low", "high", "num", "den", "bin"]
    counted = rows.groupingSets([[*keys, "day"], [*keys, *cell]], *keys, "day", *cell).agg(
        F.count("*").alias("n"), F.count("value").alias("valued"), F.grouping("day").alias("by_bin")
    )
    days = counted.where("by_bin = 0")
    bins = counted.where("by_bin = 1 AND valued > 0").drop("n").withColumnRenamed("valued", "n")
    return _shaped(days, DAY), _shaped(bins, DURATION)


def cube_of(tables):
    """The cube of the three gold or serving tables."""
    statuses = tables["shipments"].groupBy(*PLACES, F.col("current_status").alias("label")).agg(F.count("*").alias("n"))
    locations = tables["routes"].groupBy(*PLACES, F.col("location").alias("label")).agg(
        F.sum("total_shipments").alias("n"), F.sum("total_value_at_risk").alias("amount")
    )
    parts = [_shaped(statuses, STATUS), *_performance_parts(tables["performance"]), _shaped(locations, LOCATION)]
    return reduce(lambda left, right: left.unionByName(right), parts)


def _views(cube):
    """The cube's rows under the names of the tables that they come from."""
    kind = F.col("kind")
    return {
        "shipments": cube.where(kind == STATUS),
        "performance": cube.where(kind.isin(DAY, DURATION)),
        "routes": cube.where(kind == LOCATION),
    }


def _total(condition=None, column="n"):
    value = F.col(column) if condition is None else F.when(condition, F.col(column))
    return F.coalesce(F.sum(value), F.lit(0))


def _kpis(shipments, days, locations):
    delayed, rows = _total(known_delay(F.col("is_delayed"))), _total()
    on_time = F.when(rows > 0, F.lit(100) * (F.lit(1) - delayed / rows)).otherwise(F.lit(0.0))
    parts = (
        shipments.agg(_total().alias("total_shipments"), _total(is_open(F.col("label"))).alias("in_transit"))
        .unionByName(
            days.agg(delayed.alias("delayed_shipments"), on_time.alias("on_time_pct")), allowMissingColumns=True
        )
        .unionByName(
            locations.agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("value_at_risk")), allowMissingColumns=True
        )
    )
    return parts.agg(*[F.max(name).alias(name) for name in parts.columns])


def _counts(rows, column, name):
    rows = rows.where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias(name)).agg(F.sum("n").alias("n"))


def _top(days, column):
    return for_display(largest(_counts(days, column, column), "n", column), "n", column)


def _histogram(cells, max_bins=fixed.HISTOGRAM_BINS):
    """`operators.histogram.histogram` of the durations that the cells have counted."""
    limits = cells.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    width = limits.select(bin_width(F.col("low"), F.col("high"), max_bins).alias("width")).scalar()
    rows = cells.select("low", "num", "den", "bin", "n", width.alias("width"))
    wide = F.col("width")
    # So many bins of the cell make one of the histogram.
    times = F.round(wide["num"] * F.col("den") / (wide["den"] * F.col("num")))
    place = F.when(F.col("bin").isNull(), bin_index(F.col("low"), wide)).otherwise(F.floor(F.col("bin") / times))
    bins = rows.groupBy(place.alias("bin"), "width").agg(F.sum("n").alias("n"))

    def edge(index):
        return index * wide["num"] / wide["den"]

    return bins.select(
        edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"), "n"
    ).orderBy("bin_start")


def report_from_cube(cube, selection=Selection(), tables=None):
    """The datasets of `report.report`, from the cube alone; the tables to show next to them, if
    any, come narrowed from `tables`."""
    visible = narrow_all(_views(cube), selection)
    shipments, locations = visible["shipments"], visible["routes"]
    days = visible["performance"].where(F.col("kind") == DAY)
    cells = visible["performance"].where(F.col("kind") == DURATION)
    row = _kpis(shipments, days, locations)
    outcomes = days.groupBy(outcome(known_delay(F.col("is_delayed"))).alias("outcome")).agg(F.sum("n").alias("n"))
    at_risk = locations.where(F.col("label").isNotNull()).groupBy(F.col("label").alias("location"))
    at_risk = at_risk.agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("value_at_risk"))
    routes = locations.where(F.col("origin").isNotNull() & F.col("destination").isNotNull())
    routes = routes.groupBy(*PLACES).agg(F.sum("n").alias("total_shipments"))
    routes = routes.withColumn("route", route_label(F.col("origin"), F.col("destination")))
    datasets = {
        "kpis": row,
        "kpi_cards": kpi_cards(row),
        "status_mix": _counts(shipments, "label", "status").orderBy(F.desc("n"), "status"),
        "delay_split": outcomes.orderBy(F.desc("n"), "outcome"),
        "top_origins": _top(days, "origin"),
        "top_destinations": _top(days, "destination"),
        "duration_histogram": _histogram(cells),
        "value_at_risk_by_location": for_display(
            largest(at_risk, "value_at_risk", "location"), "value_at_risk", "location"
        ),
        "daily_volume": _counts(days, "day", "shipping_date").orderBy("shipping_date"),
        "busiest_routes": for_display(largest(routes, "total_shipments", "route"), "total_shipments", "route"),
    }
    shown = narrow_all(tables, selection) if tables else {}
    return datasets | {name: settled(df) for name, df in shown.items()}


def slicer_lists(cube):
    """The values of the place slicers."""
    views = _views(cube)
    return {name: slicer_values(name, views["shipments"], views["performance"]) for name in PLACES}
