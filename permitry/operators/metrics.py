"""Yearly statistics: opens, closes, top types and business longevity."""

from pyspark.sql import functions as F

from permitry.functions.dates import days_to_years, year_end
from permitry.operators.clean import with_status
from permitry.schemas import CLOSED_STATUSES, ISSUED_STATUSES, STATISTICS_YEARS


# columns that only the compact table has
_COMPACT = ["CountedFrom", "Licences", "IssuedDays", "ExpiryDays"]


def _life_spans(df):
    """Adds the first year a licence counts in (NULL: never), a count of one and its day numbers.

    A licence issued on 31 December has lived no day of that year and counts from the next one.
    """
    issued, expiry = F.col("IssuedDate"), F.col("ExpiryDate")
    lived = issued.isNotNull() & (expiry.isNull() | (expiry > issued))
    counted_from = F.year(issued) + (issued == year_end(F.year(issued))).cast("int")
    return df.withColumns({
        "CountedFrom": F.when(lived, counted_from), "Licences": F.lit(1).cast("bigint"),
        "IssuedDays": F.unix_date(issued).cast("bigint"), "ExpiryDays": F.unix_date(expiry).cast("bigint"),
    })


def _spans(df):
    return df if set(_COMPACT) <= set(df.columns) else _life_spans(df)


def _sums():
    return [F.sum(c).alias(c) for c in _COMPACT[1:]]


def compact(df, by=("DataSetOrigin",)):
    """All that the yearly statistics need: one row per status, type, years and ``by`` columns.

    Every statistic of this module takes this table in place of the licences and gives the same result,
    so several of them cost one pass over the licences.
    """
    keys = [*by, "Status", "BusinessType", "IssuedYear", "ExpiryYear", "CountedFrom"]
    return _spans(df).groupBy(*keys).agg(*_sums())


def _number(df):
    return F.sum("Licences") if "Licences" in df.columns else F.count(F.lit(1))


def _per_year(df, year_column, statuses, count_name):
    return with_status(df, statuses).groupBy("BusinessType", year_column).agg(_number(df).alias(count_name))


def opens_per_year(df, statuses=ISSUED_STATUSES):
    """Licences that now stand as issued, by type and year of issue."""
    return _per_year(df, "IssuedYear", statuses, "NumOpens")


def closes_per_year(df, statuses=CLOSED_STATUSES):
    """Closed licences by type and year of expiry; licences without expiry are left out."""
    return _per_year(df.where(F.col("ExpiryYear").isNotNull()), "ExpiryYear", statuses, "NumCloses")


def top_types(df, statuses, n=5):
    """The ``n`` most frequent types with their counts, ties by name."""
    counted = with_status(df, statuses).groupBy("BusinessType").agg(_number(df).alias("NumBusiness"))
    return counted.orderBy(F.desc("NumBusiness"), "BusinessType").limit(n)


def _only_top(counts, count_name, year_column, n):
    """Yearly counts of the ``n`` types with the largest totals, found from the counts themselves."""
    totals = counts.groupBy("BusinessType").agg(F.sum(count_name).alias("__total"))
    top = totals.orderBy(F.desc("__total"), "BusinessType").limit(n).select("BusinessType")
    dated = counts.where(F.col(year_column).isNotNull())
    # n rows by construction
    return dated.join(F.broadcast(top), "BusinessType", "left_semi")


def top_opens_per_year(df, statuses=ISSUED_STATUSES, n=5):
    """Opens per year of the ``n`` types with most opens."""
    return _only_top(opens_per_year(df, statuses), "NumOpens", "IssuedYear", n)


def top_closes_per_year(df, statuses=CLOSED_STATUSES, n=5):
    """Closes per year of the ``n`` types with most closed licences, dated or not."""
    counts = _per_year(df, "ExpiryYear", statuses, "NumCloses")
    return _only_top(counts, "NumCloses", "ExpiryYear", n)


def longevity(df, statuses=None, by=(), years=STATISTICS_YEARS, average="AvgLongevity"):
    """Number and mean longevity of the businesses alive in each year, by type and ``by`` columns.

    A licence counts in a year when it was issued by then and has lived at least one day. Its days run
    to 31 December of the year or to its expiry, whichever is earlier. The licences are first reduced to
    one row per group, first counted year and expiry year, holding a count and two sums of day numbers.
    Only these few rows are spread over the years, so the licence table is read and shuffled once,
    whatever the number of years.
    """
    first, last = years
    keys = [*by, "BusinessType"]
    rows = _spans(df if statuses is None else with_status(df, statuses))
    capped_from = F.least(F.coalesce("ExpiryYear", F.lit(last + 1)), F.lit(last + 1))
    grouped = (
        rows.where(F.col("CountedFrom") <= last)
        .select(
            *keys, F.greatest("CountedFrom", F.lit(first)).alias("__from"),
            F.greatest(capped_from, F.lit(first)).alias("__capped"), *_COMPACT[1:],
        )
        .groupBy(*keys, "__from", "__capped").agg(*_sums())
    )
    spread = grouped.withColumn("year", F.explode(F.sequence(F.col("__from"), F.lit(last))))
    to_year_end = F.col("Licences") * F.unix_date(year_end("year")) - F.col("IssuedDays")
    to_expiry = F.col("ExpiryDays") - F.col("IssuedDays")
    days = F.when(F.col("year") < F.col("__capped"), to_year_end).otherwise(to_expiry)
    summed = spread.groupBy("year", *keys).agg(F.sum("Licences").alias("NumBusiness"), F.sum(days).alias("__days"))
    mean = F.col("__days").cast("double") / F.col("NumBusiness")
    return summed.select(
        *by, "year", "BusinessType", "NumBusiness",
        mean.alias(average), days_to_years(mean).alias("AvgLongevityYears"),
    )


def longevity_per_year(df, years=STATISTICS_YEARS):
    """Longevity of all licences by year and type."""
    return longevity(df, years=years, average="AvgLongevityDays")


def longevity_of_issued_per_year(df, years=STATISTICS_YEARS, statuses=ISSUED_STATUSES):
    return longevity(df, statuses, years=years)


def longevity_of_closed_per_year(df, years=STATISTICS_YEARS, statuses=CLOSED_STATUSES):
    return longevity(df, statuses, years=years)


def longevity_of_issued_per_city(df, years=STATISTICS_YEARS, statuses=ISSUED_STATUSES):
    """Longevity of issued licences by origin, year and type: the input of the forecast."""
    return longevity(df, statuses, by=("DataSetOrigin",), years=years)


def by_year(df, *then):
    """Order of the written reports: by year, larger counts first."""
    return df.orderBy("year", F.desc("NumBusiness"), *then)


def distinct_statuses(df):
    return df.select("Status").distinct()
