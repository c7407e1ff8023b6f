"""One row per business from yearly snapshots."""

from pyspark.sql import functions as F

from permitry.functions.text import type_key

ADDRESS = ["House", "Street", "City", "Province", "Country", "PostalCode", "Latitude", "Longitude", "LocalArea"]


def squeeze(df, with_sub_type=True, order=("YearRecorded",), first=ADDRESS):
    """Collapse snapshots to one row per business type and name.

    Earliest issue date, latest expiry date, year and status of the last snapshot, address and
    coordinates of the first. First and last are the smallest and largest struct of the order columns
    followed by the values, a total order, so the result does not depend on partitioning and every task
    reduces its rows before the shuffle. A NULL order column comes before all others.
    """
    key = type_key("BusinessType", "BusinessSubType") if with_sub_type else F.col("BusinessType")
    ranks = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)]
    values = [F.col(c) for c in first]
    earliest = F.min(F.struct(*ranks, *values)).alias("__first")
    latest = F.max(F.struct(*ranks, F.col("YearRecorded"), F.col("Status"))).alias("__last")
    grouped = df.groupBy(key.alias("BusinessType"), "BusinessName").agg(
        F.min("IssuedDate").alias("IssueDate"), F.max("ExpiredDate").alias("ExpiryDate"), earliest, latest,
    )
    return grouped.select(
        "BusinessName", "IssueDate", "ExpiryDate",
        F.col("__last.YearRecorded").alias("Year"), F.col("__last.Status").alias("LastStatus"),
        "BusinessType", *[F.col(f"__first.{c}").alias(c) for c in first],
    )
