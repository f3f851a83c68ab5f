"""One row per key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from waybill.functions.parsing import quoted


def newest_per_key(df, keys, newest_by=()):
    """Keep, for each key, the row that is greatest in `newest_by`, then in its other columns.

    Null sorts below every value and null keys form one group. The row travels as
    one struct through `max`, so each map task sends a single row per key onwards:
    a key that holds a large share of the rows does not burden the task that
    finishes it. The total order makes the result the same on every run.
    """
    leading = [*keys, *newest_by]
    ranked = [*newest_by, *[name for name in df.columns if name not in leading]]
    winners = df.groupBy(*[quoted(name) for name in keys]).agg(
        F.max(F.struct(*[quoted(name) for name in ranked])).alias("__row")
    )
    return winners.select(
        *[
            quoted(name) if name in keys else F.col("__row").getField(name).alias(name)
            for name in df.columns
        ]
    )


def with_rank(df, keys, newest_by, rank="row_num"):
    """Number the rows of each key from the newest on."""
    order = [quoted(name).desc_nulls_last() for name in newest_by]
    spec = Window.partitionBy(*[quoted(name) for name in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(spec))


def first_ranked(df, keys, newest_by):
    """Window form of `newest_per_key`, for rows with columns that have no order (maps).

    Spark limits each key to its first row before the shuffle as well as after it.
    """
    ranked = with_rank(df, keys, newest_by)
    return ranked.filter(F.col("row_num") == 1).drop("row_num")
