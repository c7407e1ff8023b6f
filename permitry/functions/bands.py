"""Stability bands of the published report."""

from pyspark.sql import functions as F

from permitry.functions.text import _col

# Gauge bands in years (upper bounds) and the end of the scale.
BANDS = [("red", 5), ("yellow", 10), ("green", 15)]
SCALE_END = 15


def gauge_value(years):
    """Years rounded half up to a whole number and kept on the gauge's scale."""
    whole = F.floor(_col(years) + F.lit(0.5)).cast("int")
    return F.when(whole.isNotNull(), F.greatest(F.lit(0), F.least(whole, F.lit(SCALE_END))))


def stability_band(years):
    """Band of the gauge value; a value on a border belongs to the higher band."""
    value = gauge_value(years)
    band = F.when(_col(years).isNull(), F.lit(None).cast("string"))
    for name, upper in BANDS[:-1]:
        band = band.when(value < upper, F.lit(name))
    return band.otherwise(F.lit(BANDS[-1][0]))
