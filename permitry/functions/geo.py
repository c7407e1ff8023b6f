"""Coordinates: geocoder replies and filling rules."""

from pyspark.sql import functions as F

from permitry.functions.text import _col


def reply_coordinates(reply, blank_when_missing=False):
    """Latitude and longitude of a geocoder's JSON reply as a struct.

    Several places: the first one. One place: that object. None: (0, 0), or NULLs on request.
    """
    reply = _col(reply)
    found = F.get_json_object(reply, "$.query.count").try_cast("int")
    nothing = F.lit(None).cast("double") if blank_when_missing else F.lit(0.0)

    def part(name):
        first = F.get_json_object(reply, f"$.query.results.place[0].centroid.{name}")
        only = F.get_json_object(reply, f"$.query.results.place.centroid.{name}")
        value = F.when(found > 1, first).when(found == 1, only).try_cast("double")
        return F.when(found >= 1, value).otherwise(nothing)

    return F.struct(part("latitude").alias("Latitude"), part("longitude").alias("Longitude"))


def is_known(latitude, longitude):
    """A usable coordinate pair: neither part NULL and not (0, 0), the mark for "no result"."""
    latitude, longitude = _col(latitude), _col(longitude)
    return latitude.isNotNull() & longitude.isNotNull() & ((latitude != 0) | (longitude != 0))


def filled(latitude, longitude, found_latitude, found_longitude):
    """Both coordinates of a row after a lookup: replaced together, only where one is missing."""
    latitude, longitude = _col(latitude), _col(longitude)
    take = (latitude.isNull() | longitude.isNull()) & F.coalesce(
        is_known(found_latitude, found_longitude), F.lit(False)
    )
    return (
        F.when(take, _col(found_latitude)).otherwise(latitude),
        F.when(take, _col(found_longitude)).otherwise(longitude),
    )
