"""Licence dates, years and longevity."""

from pyspark.sql import functions as F

from permitry.functions.text import _col


def parse_date(c):
    """Date from text: an ISO day in the first ten characters, else ``dd-Mon-yyyy``, else NULL.

    Only ISO days have a dash in the fifth place, so each text is parsed with one pattern.
    """
    text = _col(c)
    iso = F.try_to_date(F.substring(text, 1, 10), "yyyy-M-d")
    return F.when(F.substring(text, 5, 1) == "-", iso).otherwise(F.try_to_date(text, "d-MMM-yyyy"))


def year_of(c):
    return F.year(_col(c))


def year_from_file_name(name, default_year):
    """The four digits a file name starts with, else ``default_year`` (a parameter, not the clock)."""
    digits = F.regexp_extract(_col(name), r"^(\d{4})", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(default_year))


def year_end(year):
    return F.make_date(_col(year), F.lit(12), F.lit(31))


def longevity_days(year, issued, expiry):
    """Days a licence had lived by 31 December of ``year``, capped by its expiry; 0 without issue date."""
    lived_to = F.least(_col(expiry), year_end(year))
    return F.coalesce(F.datediff(lived_to, _col(issued)), F.lit(0))


def days_to_years(c):
    return _col(c) / F.lit(365)
