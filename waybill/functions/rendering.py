"""Text forms of values for JSON and for KPI cards."""

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from waybill.functions.parsing import quoted


def grouped_integer(column):
    return F.format_number(column, 0)


def percent(column):
    return F.concat(F.format_number(column, 1), F.lit("%"))


def dollars(column):
    return F.concat(F.lit("$"), F.format_number(column, 0))


def iso_instant(column):
    """ISO-8601 text, which leaves out a fraction of zero."""
    fraction = F.date_format(column, ".SSSSSS")
    return F.concat(
        F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
    )


def json_safe(df):
    """The same rows with every date and timestamp as ISO-8601 text."""

    def safe(field):
        column = quoted(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return iso_instant(column).alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[safe(field) for field in df.schema.fields])
