"""The address cache: look up, insert, geocode, write back."""

from pyspark.sql import functions as F

from permitry.functions.geo import filled, is_known, reply_coordinates
from permitry.functions.text import address_text, blank_if_null
from permitry.schemas import ADDRESS_KEYS


def address_keys(df, keys=ADDRESS_KEYS):
    """Key columns as the cache holds them: never NULL, blank is the empty string."""
    return df.withColumns({k: blank_if_null(k) for k in keys})


def split_to_merged_address(df):
    """Six-part addresses as the three cache keys."""
    return df.select(
        F.concat(blank_if_null("House"), F.lit(" "), blank_if_null("Street")).alias("HouseStreet"),
        F.concat(blank_if_null("City"), F.lit(","), blank_if_null("Province")).alias("CityProvince"),
        blank_if_null("PostalCode").alias("PostalCode"),
    )


def one_per_key(cache, keys=ADDRESS_KEYS):
    """One entry per address: a finished one with coordinates if there is any, then the smallest."""
    rank = F.struct(
        (~F.coalesce(is_known("Latitude", "Longitude"), F.lit(False))).alias("unknown"),
        (~F.coalesce(F.col("IsUpdated"), F.lit(False))).alias("pending"),
        "Latitude", "Longitude",
    )
    best = cache.groupBy(*keys).agg(F.min(rank).alias("__best"))
    return best.select(
        (~F.col("__best.pending")).alias("IsUpdated"), *keys,
        F.col("__best.Latitude").alias("Latitude"), F.col("__best.Longitude").alias("Longitude"),
    )


def fill_coordinates(df, cache, keys=ADDRESS_KEYS):
    """Fill missing coordinates from the cache; rows that have both, or get no hit, stay as they are.

    Only cache entries with usable coordinates take part, and only rows that miss a coordinate are joined: the others
    pass through where they are, without a shuffle. The two parts are two filters on ``df``, so it should be a table or
    a scan with column expressions; write out (``session.cut``) what costs more to compute.
    """
    known = one_per_key(cache.where(is_known("Latitude", "Longitude")), keys)
    hits = known.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("Latitude").alias("__latitude"), F.col("Longitude").alias("__longitude"),
    )
    missing = F.col("Latitude").isNull() | F.col("Longitude").isNull()
    asked = df.where(missing).withColumns({f"__{k}": blank_if_null(k) for k in keys})
    found = asked.join(hits, [f"__{k}" for k in keys], "left")
    latitude, longitude = filled("Latitude", "Longitude", "__latitude", "__longitude")
    found = found.withColumns({"Latitude": latitude, "Longitude": longitude}).select(*df.columns)
    return df.where(~missing).unionByName(found)


def insert_addresses(cache, addresses, mode="keep", keys=ADDRESS_KEYS):
    """Add addresses to the cache as pending entries.

    ``keep``: known addresses keep flag and coordinates. ``replace``: they start over as pending.
    ``append``: every address is added, duplicates included.
    """
    asked = address_keys(addresses, keys).select(*keys)

    def pending(df):
        unknown = F.lit(None).cast("double")
        return df.select(F.lit(False).alias("IsUpdated"), *keys, unknown.alias("Latitude"), unknown.alias("Longitude"))

    if mode == "append":
        return cache.unionByName(pending(asked))
    new = asked.distinct()
    if mode == "keep":
        return cache.unionByName(pending(new.join(cache.select(*keys), keys, "left_anti")))
    if mode == "replace":
        kept = cache.join(new, keys, "left_anti").select(cache.columns)
        return kept.unionByName(pending(new))
    raise ValueError(f"unknown mode {mode!r}")


def pending_addresses(cache, n, keys=ADDRESS_KEYS):
    """The next ``n`` addresses to geocode, in key order, with the text to ask for."""
    waiting = cache.where(~F.coalesce(F.col("IsUpdated"), F.lit(False))).select(*keys).distinct()
    asked = waiting.orderBy(*keys).limit(n)
    return asked.withColumn("Address", address_text(*keys))


def apply_geocodes(cache, results, keys=ADDRESS_KEYS):
    """Write geocoded coordinates into the cache and mark the entries done.

    Of several results for one address the one with coordinates, then the smallest, counts.
    """
    found = one_per_key(results.withColumn("IsUpdated", F.lit(True)), keys).select(
        *keys, F.col("Latitude").alias("__latitude"), F.col("Longitude").alias("__longitude"),
        F.lit(True).alias("__hit"),
    )
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return cache.join(found, keys, "left").select(
        (hit | F.col("IsUpdated")).alias("IsUpdated"), *keys,
        F.when(hit, F.col("__latitude")).otherwise(F.col("Latitude")).alias("Latitude"),
        F.when(hit, F.col("__longitude")).otherwise(F.col("Longitude")).alias("Longitude"),
    )


def gazetteer_resolver(gazetteer, keys=ADDRESS_KEYS):
    """Resolver that looks pending addresses up in a table of known places; a miss is (0, 0)."""
    places = one_per_key(gazetteer.withColumn("IsUpdated", F.lit(True)), keys).drop("IsUpdated")

    def resolve(pending):
        found = pending.select(*keys).join(places, keys, "left")
        return found.select(
            *keys, F.coalesce("Latitude", F.lit(0.0)).alias("Latitude"),
            F.coalesce("Longitude", F.lit(0.0)).alias("Longitude"),
        )

    return resolve


def reply_resolver(replies, keys=ADDRESS_KEYS):
    """Resolver that takes coordinates from a table of geocoder replies (``keys``, ``reply``)."""
    places = replies.select(*keys, reply_coordinates("reply").alias("__at")).select(*keys, "__at.*")
    return gazetteer_resolver(places, keys)


def function_resolver(resolve_batch, keys=ADDRESS_KEYS, tasks=8):
    """Resolver around a function from a pandas frame of addresses to one with coordinates.

    The addresses are dealt to ``tasks`` tasks by their keys, which is how many calls run at the same time at most.
    """
    layout = ", ".join([f"{k} string" for k in keys] + ["Latitude double", "Longitude double"])

    def batches(frames):
        for frame in frames:
            yield resolve_batch(frame)

    return lambda pending: pending.repartition(tasks, *keys).mapInPandas(batches, layout)


def geocode_pending(cache, resolver, n, keys=ADDRESS_KEYS):
    """Resolve up to ``n`` pending addresses and write the results back."""
    return apply_geocodes(cache, resolver(pending_addresses(cache, n, keys)), keys)

