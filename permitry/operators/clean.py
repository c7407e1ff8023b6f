"""Cleaning of the canonical licence table before statistics."""

from pyspark.sql import functions as F

from permitry.functions.dates import longevity_days, parse_date, year_of

MIN_DATE_LENGTH = 8


def with_dates(df):
    """Text dates replaced by parsed ones, plus the years of issue and expiry."""
    return df.withColumns({
        "IssuedDate": parse_date("IssuedDate"), "ExpiryDate": parse_date("ExpiryDate"),
    }).withColumns({
        "IssuedYear": year_of("IssuedDate"), "ExpiryYear": year_of("ExpiryDate"),
    })


def clean_licences(df, min_name_length=None):
    """Licences with a usable issue date and a business name, dates parsed.

    ``min_name_length`` also asks for a longer name; by default any non-NULL name counts.
    """
    dated = with_dates(df.where(F.length("IssuedDate") >= MIN_DATE_LENGTH))
    named = F.col("BusinessName").isNotNull()
    if min_name_length is not None:
        named = named & (F.length("BusinessName") >= min_name_length)
    return dated.where(F.col("IssuedDate").isNotNull() & named)


def with_status(df, statuses):
    return df.where(F.col("Status").isin(list(statuses)))


def with_origin(df, origin):
    """Rows of one register."""
    return df.where(F.col("DataSetOrigin") == origin)


def with_longevity(df, year):
    """Adds each licence's longevity in days as of the end of ``year`` (a number or a column)."""
    year = F.lit(year) if isinstance(year, int) else year
    return df.withColumn("Longevity", longevity_days(year, "IssuedDate", "ExpiryDate"))
