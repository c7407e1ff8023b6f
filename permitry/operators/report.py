"""The published stability report."""

from pyspark.sql import functions as F

from permitry.functions.bands import stability_band
from permitry.functions.dates import days_to_years
from permitry.operators.vocabulary import last_wins
from permitry.schemas import ORIGIN_A, ORIGIN_B


def stability_records(trends):
    """Predictions in the published layout, stability in days."""
    return trends.select(
        "BusinessType", F.col("DataSetOrigin").alias("City"), F.col("year").alias("Year"),
        F.col("prediction").alias("Stability"),
    )


def years_text(days):
    """Days as years with two decimals."""
    return F.round(days_to_years(days), 2)


def pivot_cities(records, cities=(ORIGIN_A, ORIGIN_B), ordinal="ordinal"):
    """One row per type (upper and lower case are one) with the years of each city; the last record wins.

    Of records with the same ordinal the one whose type comes last in writing, then the larger one, wins. A type
    with no record in any of ``cities`` is a row without years.
    """
    lowered = records.withColumns({"__kind": F.lower("BusinessType"), "__place": F.struct(ordinal, "BusinessType", "Stability")})
    days = [F.max_by(F.when(F.col("City") == c, F.col("Stability")),
                     F.when(F.col("City") == c, F.col("__place"))).alias(c) for c in cities]
    latest = lowered.groupBy(F.col("__kind").alias("BusinessType")).agg(*days)
    return latest.select("BusinessType", *[years_text(c).alias(c) for c in cities])


def with_bands(report, cities=(ORIGIN_A, ORIGIN_B)):
    """Adds the band of each city's years."""
    return report.withColumns({f"{c}Band": stability_band(c) for c in cities})


def stability_of(records, business_type, ordinal="ordinal"):
    """City and years of one type, matched without regard to case."""
    wanted = records.where(F.lower("BusinessType") == business_type.lower())
    return last_wins(wanted, "City", "Stability", ordinal).select(
        F.col("key").alias("City"), years_text("value").alias("Years"),
    )
