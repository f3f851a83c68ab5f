"""Report filters: equality slicers, free-text search and slicer value lists."""

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import IllegalArgumentException
from pyspark.sql import functions as F

from waybill import fixed
from waybill.functions.parsing import as_text, quoted


@dataclass(frozen=True)
class Selection:
    """The three slicer values; `All` or nothing selects everything."""

    origin: str | None = fixed.NO_FILTER
    destination: str | None = fixed.NO_FILTER
    delay: str | None = fixed.NO_FILTER


def _chosen(value):
    return bool(value) and value != fixed.NO_FILTER


def _delay_is(value):
    # Spelled with IS NULL rather than coalesce, which Parquet could not evaluate.
    flag = F.col("is_delayed")
    return flag if value == fixed.DELAYED_LABEL else flag.isNull() | ~flag


def narrow(df, selection):
    """Apply the slicers whose column the table has."""
    if _chosen(selection.origin) and "origin" in df.columns:
        df = df.filter(F.col("origin") == selection.origin)
    if _chosen(selection.destination) and "destination" in df.columns:
        df = df.filter(F.col("destination") == selection.destination)
    if _chosen(selection.delay) and "is_delayed" in df.columns:
        df = df.filter(_delay_is(selection.delay))
    return df


def narrow_all(tables, selection):
    """Origin and destination reach every table; the delay slicer only `performance`."""
    places = Selection(selection.origin, selection.destination)
    return {
        name: narrow(df, selection if name == "performance" else places)
        for name, df in tables.items()
    }


def _checked(df, pattern):
    """Turn away a malformed expression here instead of in every task of the job."""
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException as error:
        raise ValueError(f"not a regular expression: {error}") from None
    return pattern


def search(df, query, regex=True):
    """Rows where any column, as text, matches the query in any letter case.

    The query is a regular expression unless `regex` is off. Nulls never match.
    """
    wanted = (query or "").strip()
    if not wanted or not df.columns:
        return df
    pattern = _checked(df, "(?iu)" + (wanted if regex else re.escape(wanted)))
    fields = df.schema.fields
    hits = [as_text(quoted(one.name), one.dataType).rlike(pattern) for one in fields]
    return df.filter(reduce(or_, [F.coalesce(hit, F.lit(False)) for hit in hits]))


def slicer_values(column, *tables):
    """Sorted distinct non-null values of a column over the tables that have it."""
    holders = [df for df in tables if column in df.columns]
    parts = [
        df.select(as_text(quoted(column), df.schema[column].dataType).alias(column))
        for df in holders
    ]
    if not parts:
        raise ValueError(f"no table has a column '{column}'")
    merged = reduce(lambda left, right: left.unionByName(right), parts)
    return merged.dropna().distinct().orderBy(column)
