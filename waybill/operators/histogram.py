"""Equal-width histogram with round bin edges."""

from pyspark.sql import functions as F

from waybill import fixed

_STEPS = [(mantissa, shift) for shift in (0, 1) for mantissa in (1, 2, 5)]


def bin_width(low, high, max_bins):
    """Smallest 1, 2 or 5 times a power of ten that needs at most `max_bins` aligned bins.

    The width is kept as numerator and denominator, one of which is a whole power
    of ten, so that widths below one divide without rounding twice.
    """
    finest = (high - low) / F.lit(max_bins)
    exponent = F.floor(F.log10(finest))

    def candidate(mantissa, shift):
        power = exponent + F.lit(shift)
        above = F.pow(F.lit(10.0), F.greatest(power, F.lit(0)))
        below = F.pow(F.lit(10.0), F.greatest(-power, F.lit(0)))
        return F.struct((F.lit(float(mantissa)) * above).alias("num"), below.alias("den"))

    def fits(width):
        first, last = bin_index(low, width), bin_index(high, width)
        wide_enough = width["num"] / width["den"] >= finest
        return wide_enough & (last - first < F.lit(max_bins))

    candidates = F.array(*[candidate(mantissa, shift) for mantissa, shift in _STEPS])
    single = F.struct(F.lit(1.0).alias("num"), F.lit(1.0).alias("den"))
    return F.when(low == high, single).otherwise(F.try_element_at(F.filter(candidates, fits), F.lit(1)))


def bin_index(value, width):
    return F.floor(value * width["den"] / width["num"])


def histogram(df, column, max_bins=fixed.HISTOGRAM_BINS):
    """Non-empty bins `[bin_start, bin_end)` with their counts.

    The range comes from a scalar subquery, two values however large the input;
    the counting then needs a single pass with a map-side aggregation.
    """
    values = df.select(F.col(column).cast("double").alias("value")).dropna()
    limits = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    width = limits.select(bin_width(F.col("low"), F.col("high"), max_bins).alias("width")).scalar()
    bins = (
        values.select("value", width.alias("width"))
        .groupBy(bin_index(F.col("value"), F.col("width")).alias("bin"), "width")
        .agg(F.count("*").alias("n"))
    )

    def edge(index):
        return index * F.col("width")["num"] / F.col("width")["den"]

    return bins.select(
        edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"), "n"
    ).orderBy("bin_start")
