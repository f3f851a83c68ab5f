"""Lenient parsing: text that does not parse becomes null, also under ANSI mode."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from waybill import fixed

# Every character that a Unicode-aware strip removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def quoted(name):
    """A column by its exact name, even when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_double(column):
    return column.try_cast("double")


def to_day(column, pattern=fixed.SHIPPING_DATE_PATTERN):
    return F.try_to_date(column, pattern)


def to_instant(column):
    return F.try_to_timestamp(column)


def stripped(column):
    return F.btrim(column, F.lit(WHITESPACE))


def as_text(column, data_type=None):
    """Any value as text. Doubles, where `data_type` says so, are plain decimals from 1e-4 up
    to 1e16 (`12345678.5`) and have an exponent outside (`1e+16`)."""
    text = column.cast("string")
    if not isinstance(data_type, DoubleType):
        return text
    plain = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(column)
    # Nearly all values are in this range, and are as plain as they come.
    usual = (size == 0) | ((size >= 1e-3) & (size < 1e7))
    power = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    power = F.lower(F.regexp_replace(power, r"E([+-])(\d)$", "E$10$2"))
    return (
        F.when(usual | ~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(power)
    )
