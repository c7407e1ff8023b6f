"""Both registers to canonical licences with coordinates from the address cache."""

from permitry.operators.address import (
    fill_coordinates, geocode_pending, insert_addresses, split_to_merged_address,
)
from permitry.operators.project import licences_from_register, licences_from_squeezed, unknown_addresses
from permitry.operators.squeeze import squeeze
from permitry.session import cut
from permitry.steps import fresh


def _refreshed(cache, addresses, resolver, n):
    cache = insert_addresses(cache, addresses)
    return cut(geocode_pending(cache, resolver, n) if resolver is not None else cache)


def clean_snapshots(snapshots, cache, resolver=None, n=1000, step=fresh):
    """Squeezed licences of the snapshot register and the cache after this run.

    With a ``resolver``, up to ``n`` pending addresses are geocoded first. The squeezed table and the new
    cache are written out once, the steps after them read both several times.
    """
    squeezed = step("squeezed", lambda: squeeze(snapshots))
    cache = _refreshed(cache, split_to_merged_address(unknown_addresses(squeezed)), resolver, n)
    return fill_coordinates(licences_from_squeezed(squeezed), cache), cache


def clean_register(register, cache, resolver=None, n=1000, step=fresh, **projection):
    """Licences of the positional register and the cache after this run.

    The projected licences are written out once, as addresses and coordinates are taken from them.
    """
    licences = step("projected", lambda: licences_from_register(register, **projection))
    cache = _refreshed(cache, licences, resolver, n)
    return fill_coordinates(licences, cache), cache
