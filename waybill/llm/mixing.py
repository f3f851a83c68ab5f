"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words. Its documents start with the same expected number of
copies, target / size of the source. The whole part is fixed; the fractions are rounded
together, so that the words taken stay near the target: two fractional documents exchange
mass, measured in words, until one of them is integral. Which of the two outcomes happens is
drawn such that both expectations are kept. The other document goes on with what remains.

The rounding runs as a tree. Rows are dealt to small groups of one source by the hash of
their id; each group leaves one fractional document, these are grouped `FAN_IN` at a time,
and so on until a source has one left, which is rounded to the nearer whole. A source's words
therefore miss its target by half its largest document at most. Groups are streamed in order
of size, so even a group of many rows (one repeated id) takes the memory of one row.
Random numbers are hashes of the document and the level: reruns agree.

Null text has no words; null source is a source of its own, the last. Documents without words
are drawn independently. Identical rows are drawn each on its own. An empty table has no rows.
Texts of any length count whole. Only doc_id, text and source are read, whatever other columns are
called; `mixed` returns the documents' own.
"""

import struct

import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.frames import WORD, fresh, stored, text_of

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2.0
GROUP_ROWS = 4096
FAN_IN = 64
SEED = 20_233
NEAR = 1e-9


def targets(rows):
    """(source, source_size, rows, target): one row per source.

    A source's share is in proportion to its weight, up to `MOST_COPIES` times its size;
    what a full source cannot take is shared among the others. With the sources in order of
    the level at which they fill up, those before the first source that the common level
    does not fill are full."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighted = sources.select(
        "*", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1).alias("weight")
    ).withColumn("limit", MOST_COPIES * F.col("source_size"))
    fills = (F.col("limit") / F.col("weight")).alias("fills")
    order = Window.orderBy("fills", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    measured = weighted.select("*", fills).select(
        "*",
        (SHARE * F.sum("source_size").over(everything)).alias("whole"),
        F.coalesce(
            F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ).alias("full"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    )
    level = ((F.col("whole") - F.col("full")) / F.col("open")).alias("level")
    levels = measured.select("*", level)
    common = F.max(F.when(F.col("level") <= F.col("fills"), F.col("level"))).over(everything)
    target = F.least("limit", F.coalesce(common, F.col("fills")) * F.col("weight"))
    return levels.select("source", "source_size", "rows", target.alias("target"))


def uniform(level, doc_id, mark):
    """A number in [0, 1) of the document and the level."""
    key = struct.pack("<iqq?", level, doc_id or 0, mark, doc_id is None)
    return xxhash.xxh64_intdigest(key, SEED) / 2.0**64


class Row:
    """What the rounding needs of a document, and its row to hand on."""

    __slots__ = ("doc_id", "mark", "size", "row")

    def __init__(self, doc_id, mark, size, row):
        self.doc_id, self.mark, self.size, self.row = doc_id, mark, size, row


class Pivot:
    """Pairs the fractional documents of a stream, group by group."""

    def __init__(self, level):
        self.level = level
        self.group = self.held = None

    def left(self):
        """The fractional document that a finished group leaves."""
        held, self.held = self.held, None
        return [(*held, None)] if held else []

    def take(self, group, row, fraction):
        """What is settled by this row: (row, fraction, outcome), without outcome if left over."""
        settled = []
        if group != self.group:
            settled, self.group = self.left(), group
        if self.held is None:
            self.held = row, fraction
            return settled
        other, p = self.held
        q = fraction
        # Words that can move to either side before one of the two is integral.
        up = min((1 - p) * other.size, q * row.size)
        down = min(p * other.size, (1 - q) * row.size)
        rises = uniform(self.level, row.doc_id, row.mark) * (up + down) < down
        gain = up if rises else -down
        self.held = None
        for one, value in ((other, p + gain / other.size), (row, q - gain / row.size)):
            if NEAR < value < 1 - NEAR:
                self.held = one, value
            else:
                settled.append((one, value, round(value)))
        return settled


OUT = (
    "source string, rows long, doc_id long, mark long, size long, place long, whole int, "
    "fraction double, copies int"
)


def rounded(level):
    """Rounds a stream of rows that is sorted by group; copies is null for those left over."""

    def run(batches):
        pivot = Pivot(level)

        def frame(settled):
            rows = [
                (*one.row, fraction, None if outcome is None else one.row[-1] + outcome)
                for one, fraction, outcome in settled
            ]
            names = [part.split()[0] for part in OUT.split(", ")]
            # As objects first: numbers next to nulls would become floats.
            out = pd.DataFrame(rows, columns=names, dtype=object)
            kinds = dict.fromkeys(names[1:], "Int64") | {"fraction": "float64"}
            return out.astype(kinds)

        for batch in batches:
            settled = []
            for row in batch.itertuples(index=False):
                doc_id = None if row.absent else row.id
                own = (row.source, row.rows, doc_id, row.mark, row.size, row.place, row.whole)
                one = Row(doc_id, row.mark, row.size, own)
                settled += pivot.take((row.source, row.place), one, row.fraction)
            yield frame(settled)
        yield frame(pivot.left())

    return run


def decided(rows):
    """`rows` (doc_id, source, mark, size) with copies, and the table of targets."""
    goals = stored(targets(rows), "targets")
    key = goals.select(F.col("source").alias("key"), "rows", "source_size", "target")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(key, F.col("source").eqNullSafe(F.col("key"))).withColumn("share", share)
    # Too near to a whole number to have a fraction.
    whole = F.floor(F.col("share") + NEAR).cast("int")
    groups = F.ceil(F.col("rows") / GROUP_ROWS)
    drawn = joined.select(
        "source",
        "rows",
        "doc_id",
        "mark",
        "size",
        F.pmod(F.xxhash64("doc_id", "mark"), groups).cast("long").alias("place"),
        whole.alias("whole"),
        F.greatest(F.lit(0.0), F.col("share") - whole).alias("fraction"),
    )
    chance = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "mark"), F.lit(1 << 40)) / float(1 << 40)
    is_whole = (F.col("fraction") <= NEAR) | (F.col("size") == 0)
    done = [
        drawn.where(is_whole).select(
            "source", "doc_id", "mark", "size",
            (F.col("whole") + (chance < F.col("fraction")).cast("int")).alias("copies"),
        )
    ]
    open_rows, level = drawn.where(~is_whole), 0
    most = goals.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
    groups = max(1, -(-most // GROUP_ROWS))
    while True:
        dealt = open_rows.repartition("source", "place").sortWithinPartitions(
            F.col("source").asc_nulls_last(), "place", F.desc("size"), "mark", "doc_id"
        )
        # Without null ids, so that pandas keeps whole numbers.
        dealt = dealt.select(
            "*", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("absent")
        ).drop("doc_id")
        result = stored(dealt.mapInPandas(rounded(level), OUT), "rounded")
        done.append(result.where("copies IS NOT NULL").select("source", "doc_id", "mark", "size", "copies"))
        open_rows = result.where("copies IS NULL").drop("copies")
        if groups == 1:
            break
        open_rows = open_rows.withColumn("place", F.floor(F.col("place") / FAN_IN))
        groups, level = -(-groups // FAN_IN), level + 1
    done.append(
        open_rows.select(
            "source", "doc_id", "mark", "size",
            (F.col("whole") + F.round("fraction").cast("int")).alias("copies"),
        )
    )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out, goals


def light(documents):
    text = text_of(documents)
    return documents.select(
        "doc_id",
        "source",
        F.xxhash64("doc_id", "source", text).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def mixture(documents):
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    copies, goals = decided(light(documents))
    key = goals.select(F.col("source").alias("key"), "source_size", "target")
    return copies.join(key, F.col("source").eqNullSafe(F.col("key"))).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(documents):
    """Every document as often as the mix takes it, with its own columns only. The copies of
    identical rows are shared out among them."""
    copies, _ = decided(light(documents))
    mark, size, place, key, total, rows, times = fresh(
        documents, "mark", "size", "place", "key", "total", "rows", "times"
    )
    known = copies.groupBy(F.col("mark").alias(key), F.col("size").alias(size + "_")).agg(
        F.sum("copies").alias(total), F.count("*").alias(rows)
    )
    text = text_of(documents)
    marked = documents.withColumn(mark, F.xxhash64("doc_id", "source", text)).withColumn(
        size, F.regexp_count(text, F.lit(WORD)).cast("long")
    )
    alike = Window.partitionBy(mark, size).orderBy(F.lit(0))
    joined = marked.join(
        known.withColumnsRenamed({key: mark, size + "_": size}), [mark, size]
    ).withColumn(place, F.row_number().over(alike))
    even = F.floor(F.col(total) / F.col(rows))
    times_ = even + (F.col(place) <= F.col(total) - even * F.col(rows)).cast("long")
    repeated = joined.withColumn(times, times_).where(F.col(times) > 0)
    return repeated.select(
        *documents.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)
    ).select(*documents.columns)
