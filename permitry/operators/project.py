"""Projections of both registers to the canonical licence table."""

from functools import reduce

from pyspark.sql import functions as F

from permitry.functions.text import glue, is_blank, quotes_to_space, separators_to_space
from permitry.schemas import (
    ADDRESS_KEYS_SPLIT, LICENCE_COLUMNS, OPEN_EXPIRY, ORIGIN_A, ORIGIN_B, REGISTER_POSITIONS,
)


def tag_origin(df, origin):
    return df.withColumn("DataSetOrigin", F.lit(origin))


def licences_from_squeezed(df, origin=ORIGIN_A):
    """Canonical licences from the squeezed snapshots: renamed, address parts joined."""
    return df.select(
        F.lit(origin).alias("DataSetOrigin"), "BusinessName", F.col("LastStatus").alias("Status"),
        F.col("IssueDate").alias("IssuedDate"), "ExpiryDate", "BusinessType",
        glue("House", "Street").alias("HouseStreet"), glue("City", "Province", ",").alias("CityProvince"),
        F.coalesce("PostalCode", F.lit("")).alias("PostalCode"), "Latitude", "Longitude",
    )


def derive_status(expiry):
    """A licence without expiry is open, any other closed."""
    return F.when(is_blank(expiry), F.lit("Open")).otherwise(F.lit("Closed"))


def default_expiry(expiry, cutoff=OPEN_EXPIRY):
    return F.when(is_blank(expiry), F.lit(cutoff)).otherwise(expiry)


def licences_from_register(df, origin=ORIGIN_B, cutoff=OPEN_EXPIRY, draft_cleaning=False, positions=REGISTER_POSITIONS):
    """Canonical licences from the positional register.

    Open licences get ``cutoff`` as their expiry; pass None to keep it NULL. ``draft_cleaning`` also
    turns commas into spaces, as the first draft of this step did.
    """
    tidy = separators_to_space if draft_cleaning else quotes_to_space

    def cell(name):
        return tidy(F.coalesce(F.col(df.columns[positions[name]]), F.lit("")))

    expiry = cell("expiry")
    closing = F.nullif(expiry, F.lit("")) if cutoff is None else default_expiry(expiry, cutoff)
    unknown = F.lit(None).cast("double")
    return df.select(
        F.lit(origin).alias("DataSetOrigin"),
        F.concat(cell("name_head"), F.lit(" "), cell("name_tail")).alias("BusinessName"),
        derive_status(expiry).alias("Status"), cell("issued").alias("IssuedDate"), closing.alias("ExpiryDate"),
        cell("type").alias("BusinessType"), cell("street").alias("HouseStreet"),
        cell("city").alias("CityProvince"), cell("postal").alias("PostalCode"),
        unknown.alias("Latitude"), unknown.alias("Longitude"),
    )


def without_latitude(df):
    return df.where(F.col("Latitude").isNull())


def with_any_address(df, parts=ADDRESS_KEYS_SPLIT):
    return df.where(reduce(lambda a, b: a | b, [F.col(p).isNotNull() for p in parts]))


def unknown_addresses(df, parts=ADDRESS_KEYS_SPLIT, extra=("LocalArea",)):
    """Addresses of rows without latitude that have at least one address part."""
    return with_any_address(without_latitude(df), parts).select(*parts, *extra)


def merge_licences(*tables):
    """Union of canonical licence tables by name."""
    return reduce(lambda a, b: a.unionByName(b), [t.select(*LICENCE_COLUMNS) for t in tables])
