"""Joins of rows of which a few keys have a large share."""

from pyspark.sql import functions as F

from waybill.functions.parsing import quoted

HEAVY_SHARE = 1 / 4096


def heavy_keys(rows, key, share=HEAVY_SHARE):
    """The keys with more than `share` of all rows, and into how many `pieces` of that size they
    fall: fewer than 1 / `share` rows, whatever the size of the input. Counts are combined on the
    map side, and both uses of them read one exchange."""
    counts = rows.where(quoted(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    most = counts.agg(F.sum("n") * F.lit(share)).scalar()
    return counts.where(F.col("n") > most).select(key, F.ceil(F.col("n") / most).alias("pieces"))


def spread_join(rows, others, key, share=HEAVY_SHARE):
    """`rows` joined with `others`, which has one row per key, such that no task gets a heavy key
    whole: its rows are dealt to pieces by their hash, and its row of `others` goes to each.

    Adaptive execution does so by itself where both sides come from storage; this holds behind
    any plan. `rows` is read twice, the first time for its keys.
    """
    heavy = heavy_keys(rows, key, share).withColumnRenamed(key, "__heavy")
    heavy = F.broadcast(heavy)  # fewer than 1 / share rows
    pieces = F.coalesce(F.col("pieces"), F.lit(1))
    mark = F.xxhash64(*[quoted(name) for name in rows.columns])
    left = rows.join(heavy, rows[key] == F.col("__heavy"), "left")
    left = left.select(*[rows[name] for name in rows.columns], F.pmod(mark, pieces).alias("__piece"))
    right = others.join(heavy, others[key] == F.col("__heavy"), "left")
    each = F.explode(F.sequence(F.lit(0), pieces - 1)).alias("__piece")
    right = right.select(*[others[name] for name in others.columns], each)
    return left.join(right, [key, "__piece"]).drop("__piece")
