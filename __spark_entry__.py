"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import functools
import importlib
import os
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from permitry.functions import dates, geo, text, vectors
from permitry.functions.bands import stability_band
from permitry.operators import address, forecast, metrics, project, report, similarity, vocabulary
from permitry.operators.address_store import AddressStore
from permitry.operators.clean import clean_licences, with_longevity, with_origin
from permitry.operators.cluster import cluster_types, mean_vectors, nearest_centre
from permitry.operators.least_squares import fit_from_sums, fold_of, sums_of
from permitry.operators.squeeze import squeeze
from permitry.plans import starview as star
from permitry.schemas import ADDRESS_KEYS_SPLIT
from permitry.session import cut, scratch, tune


def _optional(name):
    """The module, or None if it is not part of this copy; errors inside it are not hidden."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name is None or not f"{name}.".startswith(f"{error.name}."):
            raise
        return None


_llm = _optional("permitry.llm.queries")
_pipeline = _optional("corpus_pipeline") if _llm else None

YEARS = (1995, 2001)
FUTURE = (2002, 2011)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

ENTRY_FOLDER = os.environ.get("PERMITRY_TABLES", "/root/testdata/sf0.001")


def _day(name):
    return F.col(name).cast("string").alias(name)


# ---- yearly statistics


ISSUED, CLOSED = metrics.ISSUED_STATUSES, metrics.CLOSED_STATUSES


def opens_per_year(spark, sf):
    return metrics.opens_per_year(star.licences(spark, sf, expiry=False, statuses=ISSUED))


def closes_per_year(spark, sf):
    return metrics.closes_per_year(star.licences(spark, sf, statuses=CLOSED))


def top_types_opens(spark, sf):
    return metrics.top_types(star.licences(spark, sf, expiry=False, statuses=ISSUED), ISSUED)


def top_types_closes(spark, sf):
    return metrics.top_types(star.licences(spark, sf, expiry=False, statuses=CLOSED), CLOSED)


def _by_priority(spark, sf, statuses, expiry):
    """Licences typed by segment and priority: 25 types, so that a top five leaves some out."""
    rows = star.licences(spark, sf, expiry, statuses=statuses)
    return rows.withColumn("BusinessType", text.type_key("BusinessType", "BusinessSubType"))


def top5_opens_per_year(spark, sf):
    return metrics.top_opens_per_year(_by_priority(spark, sf, ISSUED, False))


def top5_closes_per_year(spark, sf):
    return metrics.top_closes_per_year(_by_priority(spark, sf, CLOSED, True))


def longevity_all(spark, sf):
    return metrics.longevity_per_year(star.licences(spark, sf), YEARS)


def longevity_issued(spark, sf):
    return metrics.longevity_of_issued_per_year(star.licences(spark, sf, statuses=ISSUED), YEARS)


def longevity_closed(spark, sf):
    return metrics.longevity_of_closed_per_year(star.licences(spark, sf, statuses=CLOSED), YEARS)


def longevity_issued_by_city(spark, sf):
    return metrics.longevity_of_issued_per_city(star.licences(spark, sf, region=True, statuses=ISSUED), YEARS)


def longevity_closed_by_city(spark, sf):
    rows = star.licences(spark, sf, region=True, statuses=CLOSED)
    return metrics.longevity(rows, CLOSED, ("DataSetOrigin",), YEARS)


def licence_longevity(spark, sf):
    rows = with_longevity(star.licences(spark, sf), F.col("IssuedYear") + 1)
    return rows.select("o_orderkey", "Longevity", dates.days_to_years("Longevity").alias("Years"))


def status_values(spark, sf):
    return metrics.distinct_statuses(star.licences(spark, sf, expiry=False))


# ---- snapshots and projections


def squeeze_latest(spark, sf):
    rows = squeeze(star.snapshots(spark, sf), order=("IssuedDate", "o_orderkey"))
    return rows.withColumns({"IssueDate": _day("IssueDate"), "ExpiryDate": _day("ExpiryDate")})


def squeeze_no_subtype(spark, sf):
    rows = squeeze(star.snapshots(spark, sf), with_sub_type=False, order=("IssuedDate", "o_orderkey"))
    return rows.withColumns({"IssueDate": _day("IssueDate"), "ExpiryDate": _day("ExpiryDate")})


def canonical_projection(spark, sf):
    squeezed = squeeze(star.snapshots(spark, sf), order=("IssuedDate", "o_orderkey"))
    rows = project.licences_from_squeezed(squeezed)
    return rows.withColumns({"IssuedDate": _day("IssuedDate"), "ExpiryDate": _day("ExpiryDate")})


def _register(spark, sf):
    """Orders laid out as the positional register; open orders have no expiry, names hold quotes."""
    orders = star.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                                    "o_orderpriority")
    rows = orders.join(star.businesses(spark, sf, nation=True), "o_custkey")
    ended = rows.join(star.last_shipments(spark, sf), "o_orderkey", "left")
    style = "dd-MMM-yyyy"
    cells = {
        0: F.col("BusinessType"), 1: F.concat(F.lit('"'), F.col("BusinessName"), F.lit('"')),
        3: F.date_format("o_orderdate", style), 4: F.col("o_orderkey").cast("string"),
        7: F.col("o_orderpriority"), 8: F.col("n_name"), 9: F.col("n_nationkey").cast("string"),
        15: F.when(F.col("o_orderstatus") != "O", F.date_format("__shipped", style)),
    }
    return ended.select(*[cells.get(i, F.lit(None).cast("string")).alias(f"c{i}") for i in range(16)])


def register_projection(spark, sf):
    return project.licences_from_register(_register(spark, sf))


def clean_register_dates(spark, sf):
    """Some issue dates are too short or no dates, some names are missing: such licences are dropped."""
    rows = project.licences_from_register(_register(spark, sf), cutoff=None)
    day, nameless = F.col("IssuedDate"), (F.col("Status") == "Open") & (F.col("CityProvince") == "CHINA")
    issued = F.when(day.startswith("05"), F.substring(day, 1, 7)).when(day.startswith("11"), "not a date").otherwise(day)
    rows = clean_licences(rows.withColumns({"IssuedDate": issued, "BusinessName": F.when(~nameless, F.col("BusinessName"))}))
    return rows.select("BusinessName", "Status", _day("IssuedDate"), _day("ExpiryDate"),
                       "IssuedYear", F.coalesce("ExpiryYear", F.lit(0)).alias("ExpiryYear"))


def parse_dates(spark, sf):
    orders = star.table(spark, sf, "orders")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    written = (
        F.when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 5 == 2, F.upper(F.date_format(day, "dd-MMM-yyyy")))
        .when(key % 5 == 3, F.date_format(day, "yyyy/MM/dd"))
    )
    parsed = orders.select("o_orderkey", written.alias("Written"), dates.parse_date(written).alias("Parsed"))
    return parsed.select("o_orderkey", "Written", _day("Parsed"), F.coalesce(dates.year_of("Parsed"), F.lit(0)).alias("Year"))


def missing_with_address(spark, sf):
    """Every fifth order has no address part at all."""
    there = F.col("o_orderkey") % 5 != 0
    rows = star.snapshots(spark, sf)
    return project.unknown_addresses(rows.withColumns({p: F.when(there, F.col(p)) for p in ADDRESS_KEYS_SPLIT}))


def unknown_count(spark, sf):
    found = missing_with_address(spark, sf)
    return found.agg(F.count(F.lit(1)).alias("UnknownAddresses"))


def number_check(spark, sf):
    rows = star.table(spark, sf, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"),
                                                  F.col("value").cast("string").alias("v"))
    return rows.select("event_id", text.is_number("k").alias("KIsNumber"), text.is_number("event_type").alias("TypeIsNumber"),
                       text.is_number(F.concat(F.lit("-"), "v", F.lit("e3"))).alias("ExponentIsNumber"),
                       text.is_number(F.concat("k", F.lit(" x"))).alias("TailIsNumber"))


# ---- addresses


def _addresses(spark, sf):
    """An address per customer."""
    rows = star.table(spark, sf, "customer").join(star.places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("c_name").alias("HouseStreet"), F.concat_ws(",", "n_name", "r_name").alias("CityProvince"),
        F.col("n_nationkey").cast("string").alias("PostalCode"), "c_acctbal", "c_custkey", "c_mktsegment",
    )


def _cache(spark, sf):
    """Every customer's address as the cache; those of one segment are pending, overdrawn ones gave no result."""
    done = F.col("c_mktsegment") != "MACHINERY"
    return _addresses(spark, sf).select(
        done.alias("IsUpdated"), "HouseStreet", "CityProvince", "PostalCode",
        F.when(done, F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(0.0)).alias("Latitude"),
        F.when(done, F.when(F.col("c_acctbal") > 0, -F.col("c_acctbal")).otherwise(0.0)).alias("Longitude"),
    )


def _addressed_rows(spark, sf):
    """Orders with their customer's address, suppliers with one the cache does not know.

    Pending orders and suppliers have no coordinates, finished orders only one of them.
    """
    orders = star.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus",
                                                    "o_totalprice")
    rows = orders.join(_addresses(spark, sf), "c_custkey")
    known = F.col("o_orderstatus") != "P"
    ordered = rows.select(
        F.col("o_orderkey").alias("id"), "HouseStreet", "CityProvince", "PostalCode",
        F.when(known, F.col("o_totalprice")).alias("Latitude"),
        F.when(F.col("o_orderstatus") == "O", -F.col("o_totalprice")).alias("Longitude"),
    )
    unknown = F.lit(None).cast("double")
    supplied = star.table(spark, sf, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("id"), F.col("s_name").alias("HouseStreet"),
        F.lit("").alias("CityProvince"), F.col("s_nationkey").cast("string").alias("PostalCode"),
        unknown.alias("Latitude"), unknown.alias("Longitude"),
    )
    return ordered.unionByName(supplied)


def cache_fill(spark, sf):
    return address.fill_coordinates(_addressed_rows(spark, sf), _cache(spark, sf))


def _insert(mode):
    def run(spark, sf):
        return address.insert_addresses(_cache(spark, sf), _addressed_rows(spark, sf), mode)
    return run


def cache_apply(spark, sf):
    """Geocodes of the pending addresses: the segment's balances and their halves."""
    found = _addresses(spark, sf).where(F.col("c_mktsegment") == "MACHINERY").select(
        "HouseStreet", "CityProvince", "PostalCode", F.col("c_acctbal").alias("Latitude"),
        (F.col("c_acctbal") / 2).alias("Longitude"))
    return address.apply_geocodes(_cache(spark, sf), found)


def cache_versions(spark, sf):
    """The cache kept as buckets and deltas: addresses added, geocodes of ``cache_apply`` written, deltas compacted, read back."""
    found = _addresses(spark, sf).where(F.col("c_mktsegment") == "MACHINERY").select(
        "HouseStreet", "CityProvince", "PostalCode", F.col("c_acctbal").alias("Latitude"),
        (F.col("c_acctbal") / 2).alias("Longitude"))
    store = AddressStore(spark, scratch(spark, "store"))
    store.create(_cache(spark, sf), buckets=16)
    store.insert(_addressed_rows(spark, sf))
    store.compact()
    store.apply(found)
    return store.read()


def pending_top_n(spark, sf):
    return address.pending_addresses(_cache(spark, sf), 100)


def geocode_pending(spark, sf):
    places = _addresses(spark, sf).where(F.col("c_acctbal") > 0).select(
        "HouseStreet", "CityProvince", "PostalCode", F.col("c_acctbal").alias("Latitude"),
        (F.col("c_acctbal") * 2).alias("Longitude"))
    return address.geocode_pending(_cache(spark, sf), address.gazetteer_resolver(places), 50)


def _replies(spark, sf):
    """Geocoder replies made of the event properties: none, one or several places."""
    events = star.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    place = F.format_string('{"centroid":{"latitude":"%d","longitude":"-%d"}}', k, k)
    other = F.lit('{"centroid":{"latitude":"1","longitude":"2"}}')
    body = (
        F.when(k % 3 == 0, F.lit('{"query":{"count":0,"results":null}}'))
        .when(k % 3 == 1, F.concat(F.lit('{"query":{"count":1,"results":{"place":'), place, F.lit("}}}")))
        .otherwise(F.concat(F.lit('{"query":{"count":2,"results":{"place":['), place, F.lit(","), other, F.lit("]}}}")))
    )
    return events.select("event_id", body.alias("reply"))


def geocode_reply_extract(spark, sf):
    at = geo.reply_coordinates("reply")
    return _replies(spark, sf).select("event_id", at.alias("at")).select("event_id", "at.*")


# ---- vocabularies


def token_counts(spark, sf):
    return vocabulary.word_counts(
        vocabulary.append_types(star.type_vocabulary(spark, sf), star.brand_vocabulary(spark, sf)))


def token_counts_documents(spark, sf):
    return vocabulary.word_counts(star.table(spark, sf, "documents"), "text")


def jaccard_pairs(spark, sf):
    return similarity.jaccard_pairs(star.brand_vocabulary(spark, sf), star.type_vocabulary(spark, sf), at_least=0.2)


def jaccard_pairs_half(spark, sf):
    return similarity.jaccard_pairs(star.brand_vocabulary(spark, sf), star.type_vocabulary(spark, sf), at_least=0.5)


def jaccard_top_n(spark, sf):
    return similarity.jaccard_top(star.brand_vocabulary(spark, sf), star.type_vocabulary(spark, sf), 1000)


def _vectors(spark, sf):
    types = vocabulary.append_types(star.type_vocabulary(spark, sf), star.brand_vocabulary(spark, sf))
    return star.word_vectors(spark, sf, vocabulary.word_counts(types))


def rwmd_pairs(spark, sf):
    found = similarity.relaxed_pairs(
        star.brand_vocabulary(spark, sf), star.type_vocabulary(spark, sf), _vectors(spark, sf), within=0.75)
    return found.withColumn("distance", F.round("distance", 6))


def rwmd_top_n(spark, sf):
    found = similarity.relaxed_top(
        star.brand_vocabulary(spark, sf), star.type_vocabulary(spark, sf), _vectors(spark, sf), 1000, digits=6)
    return found


def word_cosine(spark, sf):
    words = star.table(spark, sf, "embeddings").select("vec_id", "embedding")
    after = words.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return words.join(after, "vec_id").select("vec_id", F.round(vectors.cosine("embedding", "next"), 6).alias("cosine"))


def _entities(spark, sf):
    rows = star.part_labels(spark, sf).select(
        F.col("brand").alias("BusinessType1"), F.col("type").alias("BusinessType2"), F.col("label").alias("IsMatch(Yes/No)"),
        "ordinal")
    return vocabulary.entity_map(rows)


def _clusters(spark, sf):
    rows = star.part_labels(spark, sf).where(F.col("p_size") > 10).select(
        F.col("brand").alias("type"), F.concat_ws("-", F.lit("cluster"), "p_size").alias("cluster_name"), "ordinal")
    return vocabulary.cluster_map(rows)


def first_wins(spark, sf):
    return vocabulary.first_wins(star.part_labels(spark, sf), "type", "p_size")


def last_wins(spark, sf):
    return vocabulary.last_wins(star.part_labels(spark, sf), "type", "p_size")


def entity_map(spark, sf):
    return _entities(spark, sf)


def business_types(spark, sf):
    return vocabulary.business_types(star.licences(spark, sf, expiry=False))


def apply_type_map(spark, sf):
    """Line items typed by part, type replaced by its label cluster where the part is labelled."""
    lines = star.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = star.part_labels(spark, sf).select(F.col("ordinal").alias("l_partkey"), F.col("brand").alias("BusinessType"))
    facts = lines.join(parts, "l_partkey")
    return vocabulary.replace_types(facts, _clusters(spark, sf)).groupBy("BusinessType").agg(F.count(F.lit(1)).alias("Rows"))


def unmapped_types(spark, sf):
    return vocabulary.unmapped_rows(star.brand_vocabulary(spark, sf), _clusters(spark, sf))


def type_to_cluster(spark, sf):
    types = vocabulary.append_types(star.type_vocabulary(spark, sf), star.brand_vocabulary(spark, sf))
    return vocabulary.type_to_cluster(types, _entities(spark, sf), _clusters(spark, sf))


def vocab_union(spark, sf):
    return vocabulary.union_types(star.type_vocabulary(spark, sf), star.brand_vocabulary(spark, sf))


def vocab_append(spark, sf):
    parts = star.part_labels(spark, sf)
    return vocabulary.append_types(*[parts.select(F.col(c).alias("BusinessType")).distinct() for c in ("name", "type", "name")])


def merged_vocabulary(spark, sf):
    return vocabulary.merged_vocabulary(
        star.type_vocabulary(spark, sf), star.brand_vocabulary(spark, sf), _entities(spark, sf))


def cluster_business_types(spark, sf):
    return cluster_types(vocab_union(spark, sf))


# ---- forecast and report


def future_grid(spark, sf):
    return forecast.future_grid(star.licences(spark, sf, expiry=False, region=True), FUTURE)


def future_counts(spark, sf):
    history = cut(longevity_issued_by_city(spark, sf))
    return forecast.with_last_count(forecast.future_grid(history, FUTURE), history)


def _records(spark, sf):
    """Longevity of every year as published records, later years later."""
    rows = longevity_issued_by_city(spark, sf)
    return rows.select("BusinessType", F.col("DataSetOrigin").alias("City"), F.col("year").alias("Year"),
                       F.col("AvgLongevity").alias("Stability"), F.col("year").alias("ordinal"))


def stability_pivot(spark, sf):
    return report.pivot_cities(_records(spark, sf), REGIONS)


def stability_bands(spark, sf):
    rows = longevity_issued_by_city(spark, sf)
    years = F.round("AvgLongevityYears", 2)
    return rows.select("DataSetOrigin", "year", "BusinessType", years.alias("Years"), stability_band(years).alias("Band"))


def error_metrics(spark, sf):
    """Errors of predicting every licence's longevity by the mean of its group and year."""
    rows = with_longevity(star.licences(spark, sf), F.col("IssuedYear") + 1).where(F.col("Longevity") > 0)
    days = rows.groupBy("BusinessType", "IssuedYear", "Longevity").agg(F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("BusinessType", "IssuedYear")
    mean = F.sum(F.col("Longevity") * F.col("rows")).over(group).cast("double") / F.sum("rows").over(group)
    errors = forecast.error_table(days.withColumn("prediction", mean), "Longevity", by=("BusinessType",), weight="rows")
    return errors.select("BusinessType", "n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def fit_stability(spark, sf):
    history = cut(longevity_issued_by_city(spark, sf))
    model = forecast.fit_stability(history)
    return model.transform(history).select("DataSetOrigin", "year", "BusinessType", "NumBusiness", "AvgLongevity", "prediction")


def predict_trends(spark, sf):
    history = cut(longevity_issued_by_city(spark, sf))
    model = forecast.fit_stability(history)
    return forecast.predict_trends(history, model, FUTURE)


def stability_report(spark, sf):
    """Predictions as the published report: years and band of each type and city."""
    records = report.stability_records(predict_trends(spark, sf)).withColumn("ordinal", F.col("Year"))
    return report.with_bands(report.pivot_cities(records, REGIONS), REGIONS)


def regression_metrics(spark, sf):
    return forecast.error_table(fit_stability(spark, sf), by=("DataSetOrigin",))


# ---- the regression from sums of products: ridge, where the minimum is the solution of a linear system


def _ridge(history):
    return fit_from_sums(history, elastic_nets=(0.0,))


def regression_sums(spark, sf):
    """Sums of products of the features and the label by fold."""
    history = cut(longevity_issued_by_city(spark, sf))
    rows = Pipeline(stages=forecast.feature_stages()).fit(history).transform(history).withColumn("x", vector_to_array("norm_features"))
    found = sums_of(rows, "x", "AvgLongevity", fold_of(2, "DataSetOrigin", "BusinessType", "year"))
    return found.select("fold", "row", "column", F.round("value", 4).alias("total")).where("total <> 0")


def fit_ridge(spark, sf):
    history = cut(longevity_issued_by_city(spark, sf))
    return _ridge(history).transform(history).select(
        "DataSetOrigin", "year", "BusinessType", "NumBusiness", "AvgLongevity", F.round("prediction", 3).alias("prediction"))


def predict_ridge(spark, sf):
    history = cut(longevity_issued_by_city(spark, sf))
    found = forecast.predict_trends(history, _ridge(history), FUTURE)
    return found.withColumn("prediction", F.round("prediction", 3))


def ridge_report(spark, sf):
    """Predictions from sums as the published report: years and band of each type and city."""
    records = report.stability_records(predict_ridge(spark, sf)).withColumn("ordinal", F.col("Year"))
    return report.with_bands(report.pivot_cities(records, REGIONS), REGIONS)


def ridge_metrics(spark, sf):
    found = forecast.error_table(fit_ridge(spark, sf), by=("DataSetOrigin",))
    return found.select("DataSetOrigin", "n", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"))


# ---- the deterministic steps of training, and small rules


def feature_vectors(spark, sf):
    """Inputs of the regression: indices by frequency, one-hot slot of the type, parts of the unit vector."""
    history = cut(longevity_issued_by_city(spark, sf))
    rows = Pipeline(stages=forecast.feature_stages()).fit(history).transform(history)
    unit = vector_to_array("norm_features")
    rows = rows.withColumns({"unit": unit, "hot": vector_to_array("BusinessTypeHot")})
    return rows.select(
        "DataSetOrigin", "BusinessType", "year", "NumBusiness", "DataSetOriginIndex", "BusinessTypeIndex",
        F.array_position("hot", 1.0).cast("int").alias("HotSlot"), F.round(F.element_at("unit", 1), 9).alias("CityPart"),
        F.round(F.element_at("unit", -2), 9).alias("YearPart"), F.round(F.element_at("unit", -1), 9).alias("NumberPart"))


def type_vectors(spark, sf):
    """Mean word vector of every type, its first two parts and its length."""
    rows = vocabulary.token_table(star.type_vocabulary(spark, sf))
    found = mean_vectors(rows, star.word_vectors(spark, sf, vocabulary.word_counts(star.type_vocabulary(spark, sf))))
    return found.select(F.col("business").alias("BusinessType"), F.round(F.element_at("vec", 1), 6).alias("First"),
                        F.round(F.element_at("vec", 2), 6).alias("Second"), F.round(vectors.norm("vec"), 6).alias("Length"))


def cluster_given_vectors(spark, sf):
    """Types clustered by the means of given word vectors, two rounds of k-means from fixed centres."""
    types = star.type_vocabulary(spark, sf)
    found = cluster_types(types, 12, vectors=star.word_vectors(spark, sf, vocabulary.word_counts(types)), rounds=2)
    return found.select(F.col("business").alias("BusinessType"), F.col("cluster").cast("int").alias("cluster"))


def nearest_cluster(spark, sf):
    """Every embedding with the nearest of thirty given centres."""
    rows = star.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    centres = rows.where(F.col("vec_id") < 30).select(F.col("vec_id").alias("cluster"), F.col("vec").alias("centre"))
    return nearest_centre(rows, centres).select("vec_id", "cluster")


def near_vectors(spark, sf):
    """Pairs of embeddings that are near each other, as the word-mover join looks for near words."""
    rows = star.table(spark, sf, "embeddings")
    lexicon = rows.select(F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vec"), F.lit(1).alias("in_left"),
                          F.lit(1).alias("in_right"), vectors.norm("embedding").alias("at"))
    found = similarity.near_words(lexicon, 0.9)
    return found.select(F.col("near").cast("bigint").alias("near"), F.col("word").cast("bigint").alias("vec_id"))


def licences_of_city(spark, sf):
    return with_origin(star.licences(spark, sf, expiry=False, region=True), "ASIA").select("o_orderkey", "DataSetOrigin", "Status")


def merged_licences(spark, sf):
    """Licences of both registers in one table."""
    return project.merge_licences(canonical_projection(spark, sf), register_projection(spark, sf))


def cache_fill_six_keys(spark, sf):
    """As ``cache_fill`` with addresses of six parts, one of them never known."""
    six = {"House": "HouseStreet", "Street": "c_mktsegment", "City": "CityProvince", "Province": "c_custkey", "PostalCode": "PostalCode"}

    def parts(rows, country):
        return rows.withColumns({part: F.col(source).cast("string") for part, source in six.items()}).withColumn("Country", country)

    orders = star.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_totalprice")
    rows = parts(orders.join(_addresses(spark, sf), "c_custkey"), F.lit(None).cast("string")).select(
        F.col("o_orderkey").alias("id"), *ADDRESS_KEYS_SPLIT, F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("Latitude"),
        F.when(F.col("o_orderstatus") == "O", -F.col("o_totalprice")).alias("Longitude"))
    known = F.col("c_acctbal") > 0
    cache = parts(_addresses(spark, sf), F.lit("")).select(
        known.alias("IsUpdated"), *ADDRESS_KEYS_SPLIT, F.when(known, F.col("c_acctbal")).alias("Latitude"),
        F.when(known, -F.col("c_acctbal")).alias("Longitude"))
    return address.fill_coordinates(rows, cache, ADDRESS_KEYS_SPLIT).select("id", "House", "Latitude", "Longitude")


def quote_rules(spark, sf):
    quoted = F.concat(F.lit('"'), "p_name", F.lit('", "'), "p_type", F.lit('",'), "p_brand")
    return star.table(spark, sf, "part").select(
        "p_partkey", text.quotes_to_space(quoted).alias("NoQuotes"), text.separators_to_space(quoted).alias("NoSeparators"),
        text.drop_quotes(quoted).alias("Dropped"), text.drop_quotes(quoted, comma_to_space=True).alias("Draft"))


def year_from_name(spark, sf):
    """Years of made-up file names; every third has none."""
    day = F.date_format("o_orderdate", "yyyy")
    name = F.when(F.col("o_orderkey") % 3 == 0, "licences.csv").otherwise(F.concat(day, F.lit("business_licences.csv")))
    rows = star.table(spark, sf, "orders").select("o_orderkey", name.alias("Name"))
    return rows.select("o_orderkey", dates.year_from_file_name("Name", 2017).cast("int").alias("Year"))


def most_frequent_words(spark, sf):
    return vocabulary.by_count(token_counts_documents(spark, sf)).limit(100)


def largest_groups_by_year(spark, sf):
    return metrics.by_year(longevity_issued(spark, sf), "BusinessType").select("year", "BusinessType", "NumBusiness").limit(20)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: longevity of issued licences by city, year and type."""
    return longevity_issued_by_city(tune(spark), ENTRY_FOLDER)


_QUERIES = [
    opens_per_year, closes_per_year, top_types_opens, top_types_closes, top5_opens_per_year, top5_closes_per_year,
    longevity_all, longevity_issued, longevity_closed, longevity_issued_by_city, longevity_closed_by_city,
    licence_longevity, status_values, squeeze_latest, squeeze_no_subtype, canonical_projection, register_projection,
    clean_register_dates, parse_dates, missing_with_address, unknown_count, number_check, cache_fill, cache_apply, cache_versions,
    pending_top_n, geocode_pending, geocode_reply_extract, token_counts, token_counts_documents, jaccard_pairs,
    jaccard_pairs_half, jaccard_top_n, rwmd_pairs, rwmd_top_n, word_cosine, first_wins, last_wins, entity_map,
    business_types, apply_type_map, unmapped_types, type_to_cluster, vocab_union, vocab_append, merged_vocabulary,
    cluster_business_types, future_grid, future_counts, stability_pivot, stability_bands, error_metrics, fit_stability,
    predict_trends, stability_report, regression_metrics, feature_vectors, type_vectors, cluster_given_vectors, nearest_cluster, near_vectors,
    licences_of_city, merged_licences, cache_fill_six_keys, quote_rules, year_from_name, most_frequent_words,
    largest_groups_by_year, regression_sums, fit_ridge, predict_ridge, ridge_report, ridge_metrics,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries by name; each takes the session and a folder of parquet tables."""
    named = {query.__name__: query for query in _QUERIES}
    named["cache_upsert"] = _insert("keep")
    named["cache_upsert_append"] = _insert("append")
    named["cache_upsert_replace"] = _insert("replace")
    if _llm:
        named.update(_llm.queries())
    if _llm and _pipeline:
        named["pipeline"] = _pipeline.run
    return {name: _tuned(query) for name, query in named.items()}


def _tuned(query):
    """The query under the settings the operators are written for."""
    @functools.wraps(query)
    def run(spark, sf):
        return query(tune(spark), sf)
    return run


# ---- the same in SQL

_SHIP = "ship AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS shipped FROM lineitem GROUP BY l_orderkey)"

_LIC = f"""{_SHIP},
lic AS (
  SELECT o_orderkey, r_name AS DataSetOrigin, n_name, n_nationkey, c_name AS BusinessName,
         c_mktsegment AS BusinessType, o_orderpriority AS BusinessSubType,
         CASE o_orderstatus WHEN 'O' THEN 'Issued' WHEN 'F' THEN 'Cancelled' ELSE 'Pending' END AS Status,
         CAST(o_orderdate AS DATE) AS IssuedDate,
         CASE WHEN o_orderstatus <> 'O' OR o_orderkey % 4 = 0 THEN shipped END AS ExpiryDate,
         CAST(year(o_orderdate) AS INTEGER) AS IssuedYear
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN ship ON l_orderkey = o_orderkey)"""

_ISSUED = "('Issued', 'Open')"
_CLOSED = "('Cancelled', 'Closed', 'Gone Out of Business')"


def _longevity_sql(where="TRUE", by="", average="AvgLongevity"):
    return f"""WITH {_LIC},
    alive AS (
      SELECT lic.*, CAST(y AS INTEGER) AS year,
             date_diff('day', IssuedDate, least(ExpiryDate, make_date(y, 12, 31))) AS days
      FROM lic, (SELECT unnest(range({YEARS[0]}, {YEARS[1] + 1})) AS y) WHERE IssuedYear <= y AND {where})
    SELECT {by} year, BusinessType, count(*) AS NumBusiness,
           CAST(sum(days) AS DOUBLE) / count(*) AS {average},
           CAST(sum(days) AS DOUBLE) / count(*) / 365 AS AvgLongevityYears
    FROM alive WHERE days > 0 GROUP BY {by} year, BusinessType"""


_ISSUED_BY_CITY = _longevity_sql(f"Status IN {_ISSUED}", "DataSetOrigin,")


def _ridge_sql(tail):
    """Ridge regression in SQL: features, sums of products, scaled system, elimination, and a table ``model``."""
    def by_frequency(column):
        return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i FROM hist GROUP BY {column})"""

    def featured(table):
        return f"""SELECT s.*, list_transform(raw, lambda v: v / sqrt(list_sum(list_transform(raw, lambda u: u * u)))) AS x FROM (
              SELECT {table}.*, list_concat(list_concat([CAST(c.i AS DOUBLE)], list_transform(range((SELECT count(DISTINCT BusinessType) FROM hist) - 1),
                lambda k: CASE WHEN k = t.i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), [CAST(year AS DOUBLE), CAST(NumBusiness AS DOUBLE)]) AS raw
              FROM {table} JOIN {by_frequency('DataSetOrigin')} c USING (DataSetOrigin) JOIN {by_frequency('BusinessType')} t USING (BusinessType)) s"""

    return f"""WITH RECURSIVE hist AS ({_ISSUED_BY_CITY}), f AS ({featured('hist')}),
        z AS (SELECT list_concat(list_concat([1.0::DOUBLE], x), [AvgLongevity]) AS z,
              CAST('0x' || substr(md5(DataSetOrigin || '|' || BusinessType || '|' || year), 1, 8) AS BIGINT) % 2 AS fold FROM f),
        place AS (SELECT CAST(unnest(range(0, (SELECT max(len(z)) FROM z))) AS INTEGER) AS i),
        sums AS (SELECT fold, a.i AS i, b.i AS j, sum(z[a.i + 1] * z[b.i + 1]) AS s FROM z, place a, place b GROUP BY ALL),
        whole AS (SELECT i, j, sum(s) AS s FROM sums GROUP BY i, j),
        n AS (SELECT s AS n FROM whole WHERE i = 0 AND j = 0), label AS (SELECT max(i) AS y FROM place),
        mean AS (SELECT i, s / n AS m FROM whole, n WHERE j = 0),
        spread AS (SELECT w.i, w.j, w.s / n - a.m * b.m AS s FROM whole w JOIN mean a ON a.i = w.i JOIN mean b ON b.i = w.j, n),
        scale AS (SELECT i, sqrt(greatest(s, 0)) AS d FROM spread WHERE i = j),
        wide AS (SELECT i, d FROM scale, label WHERE i BETWEEN 1 AND y - 1),
        cells AS (SELECT s.i, s.j, CASE WHEN s.j = y THEN s.s / a.d ELSE s.s / a.d / b.d + CASE WHEN s.i = s.j THEN 0.3 / l.d ELSE 0 END END AS s
              FROM spread s JOIN wide a ON a.i = s.i JOIN scale b ON b.i = s.j, label JOIN scale l ON l.i = y WHERE s.j BETWEEN 1 AND y),
        start AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(s ORDER BY j) AS r FROM cells GROUP BY i)),
        steps AS (SELECT 1 AS k, m FROM start UNION ALL
              SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
                ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM steps WHERE k <= len(m)),
        solved AS (SELECT list_transform(m, lambda r: r[len(r)]) AS w FROM steps ORDER BY k DESC LIMIT 1),
        model AS (SELECT list(w[i] / d ORDER BY i) AS w, any_value(top.m) - sum(mean.m * w[i] / d) AS b
              FROM solved, wide JOIN mean USING (i), (SELECT m FROM mean, label WHERE i = y) top),
        grid AS (SELECT * FROM (SELECT DISTINCT BusinessType FROM hist) CROSS JOIN (SELECT DISTINCT DataSetOrigin FROM hist)
              CROSS JOIN (SELECT unnest(range({FUTURE[0]}, {FUTURE[1] + 1})) AS y)),
        latest AS (SELECT DataSetOrigin, BusinessType, arg_max(NumBusiness, year) AS n FROM hist GROUP BY ALL),
        averages AS (SELECT DataSetOrigin, avg(NumBusiness) AS m FROM hist GROUP BY ALL),
        future AS (SELECT CAST(y AS INTEGER) AS year, BusinessType, DataSetOrigin, coalesce(CAST(n AS DOUBLE), m) AS NumBusiness
              FROM grid LEFT JOIN latest USING (DataSetOrigin, BusinessType) LEFT JOIN averages USING (DataSetOrigin)),
        fitted AS (SELECT f.*, round(b + list_sum(list_transform(x, lambda v, i: v * w[i])), 3) AS prediction FROM f, model),
        told AS (SELECT g.*, round(b + list_sum(list_transform(x, lambda v, i: v * w[i])), 3) AS prediction FROM ({featured('future')}) g, model)
        {tail}"""


def _squeeze_sql(type_key):
    def pick(kind, column):
        return f"{kind}({column} ORDER BY IssuedDate, o_orderkey)"

    latitude = "CASE WHEN Status <> 'Pending' THEN CAST(o_orderkey AS DOUBLE) END"
    return f"""SELECT BusinessName, CAST(min(IssuedDate) AS VARCHAR) AS IssueDate, CAST(max(ExpiryDate) AS VARCHAR) AS ExpiryDate,
      {pick('last', 'IssuedYear')} AS Year, {pick('last', 'Status')} AS LastStatus, {type_key} AS BusinessType,
      {pick('first', 'CAST(o_orderkey AS VARCHAR)')} AS House, {pick('first', 'BusinessSubType')} AS Street,
      {pick('first', 'n_name')} AS City, {pick('first', 'DataSetOrigin')} AS Province,
      CAST(NULL AS VARCHAR) AS Country, {pick('first', 'CAST(n_nationkey AS VARCHAR)')} AS PostalCode,
      {pick('first', latitude)} AS Latitude, {pick('first', '-(' + latitude + ')')} AS Longitude,
      CAST(NULL AS VARCHAR) AS LocalArea
    FROM lic GROUP BY {type_key}, BusinessName"""


_SQUEEZE_KEY = "(BusinessType || ' ' || BusinessSubType)"

_REGISTER = f"""{_SHIP},
reg AS (
  SELECT c_mktsegment AS type, ' ' || c_name || ' ' AS tail, strftime(o_orderdate, '%d-%b-%Y') AS issued,
         CAST(o_orderkey AS VARCHAR) AS head, o_orderpriority AS street, n_name AS city,
         CAST(n_nationkey AS VARCHAR) AS postal, CAST(o_orderdate AS DATE) AS issued_day,
         CASE WHEN o_orderstatus <> 'O' THEN shipped END AS expiry_day,
         CASE WHEN o_orderstatus <> 'O' THEN strftime(shipped, '%d-%b-%Y') END AS expiry
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN ship ON l_orderkey = o_orderkey)"""

_ADDRESS = """addr AS (
  SELECT c_name AS HouseStreet, n_name || ',' || r_name AS CityProvince, CAST(n_nationkey AS VARCHAR) AS PostalCode,
         c_acctbal, c_custkey, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
cache AS (
  SELECT c_mktsegment <> 'MACHINERY' AS IsUpdated, HouseStreet, CityProvince, PostalCode,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN greatest(c_acctbal, 0.0) END AS Latitude,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN CASE WHEN c_acctbal > 0 THEN -c_acctbal ELSE 0.0 END END AS Longitude
  FROM addr),
ord AS (
  SELECT o_orderkey AS id, HouseStreet, CityProvince, PostalCode,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS Latitude,
         CASE WHEN o_orderstatus = 'O' THEN -o_totalprice END AS Longitude
  FROM orders JOIN addr ON o_custkey = c_custkey
  UNION ALL SELECT -s_suppkey - 1, s_name, '', CAST(s_nationkey AS VARCHAR), NULL, NULL FROM supplier)"""

_PENDING = "FALSE AS IsUpdated, HouseStreet, CityProvince, PostalCode, CAST(NULL AS DOUBLE) AS Latitude, CAST(NULL AS DOUBLE) AS Longitude"
#: A round of k-means: rows to the nearest centre, centres to the means of their rows.
_LLOYD = """a{at} AS (SELECT t, any_value(v) AS v, arg_min(c, list_distance(v, cv)) AS c FROM typed CROSS JOIN c{at} GROUP BY t),
            m{at} AS (SELECT c, k, avg(x) AS x FROM (SELECT c, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM a{at}) GROUP BY c, k),
            c{next} AS (SELECT c, list(x ORDER BY k) AS cv FROM m{at} GROUP BY c
              UNION ALL SELECT c, cv FROM c{at} WHERE c NOT IN (SELECT c FROM a{at}))"""
_SAME = "c.HouseStreet = a.HouseStreet AND c.CityProvince = a.CityProvince AND c.PostalCode = a.PostalCode"

_TYPES = """types AS (SELECT DISTINCT p_type || ' ' || p_name AS BusinessType FROM part),
brands AS (SELECT DISTINCT p_brand || ' ' || p_name AS BusinessType FROM part)"""


def _stop_list():
    from permitry.schemas import STOP_WORDS
    return ", ".join(f"'{w}'" for w in STOP_WORDS)


def _words_sql(table, column):
    """Rows (t, word): every kept word of every text."""
    return f"""SELECT t, lower(w) AS word FROM (
        SELECT {column} AS t, unnest(regexp_split_to_array({column}, '[^A-Za-z0-9]+')) AS w FROM {table})
      WHERE w <> '' AND lower(w) NOT IN ({_stop_list()})"""


def _jaccard_sql(tail):
    return f"""WITH {_TYPES},
    l AS (SELECT t, list(DISTINCT word) AS w FROM ({_words_sql('brands', 'BusinessType')}) GROUP BY t),
    r AS (SELECT t, list(DISTINCT word) AS w FROM ({_words_sql('types', 'BusinessType')}) GROUP BY t),
    scored AS (
      SELECT l.t AS "left", r.t AS "right",
             CAST(len(list_intersect(l.w, r.w)) AS DOUBLE) / (len(l.w) + len(r.w) - len(list_intersect(l.w, r.w))) AS score
      FROM l CROSS JOIN r WHERE len(list_intersect(l.w, r.w)) > 0)
    SELECT "left", "right", score FROM scored {tail}"""


def _rwmd_sql(tail):
    return f"""WITH {_TYPES},
    lw AS ({_words_sql('brands', 'BusinessType')}),
    rw AS ({_words_sql('types', 'BusinessType')}),
    vec AS (
      SELECT word, CAST(embedding AS DOUBLE[]) AS v FROM (SELECT DISTINCT word FROM (SELECT word FROM lw UNION ALL SELECT word FROM rw))
      JOIN embeddings ON vec_id = CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings)),
    cost AS (SELECT a.word AS wa, b.word AS wb, list_distance(a.v, b.v) AS c FROM vec a CROSS JOIN vec b),
    lb AS (SELECT t, word, count(*) / sum(count(*)) OVER (PARTITION BY t) AS share FROM lw SEMI JOIN vec USING (word) GROUP BY t, word),
    rb AS (SELECT t, word, count(*) / sum(count(*)) OVER (PARTITION BY t) AS share FROM rw SEMI JOIN vec USING (word) GROUP BY t, word),
    met AS (
      SELECT lb.t AS lt, rb.t AS rt, lb.word AS la, rb.word AS ra, lb.share AS ls, rb.share AS rs, c
      FROM lb CROSS JOIN rb JOIN cost ON wa = lb.word AND wb = rb.word),
    there AS (SELECT lt, rt, sum(ls * m) AS d FROM (SELECT lt, rt, la, any_value(ls) AS ls, min(c) AS m FROM met GROUP BY lt, rt, la) GROUP BY lt, rt),
    back AS (SELECT lt, rt, sum(rs * m) AS d FROM (SELECT lt, rt, ra, any_value(rs) AS rs, min(c) AS m FROM met GROUP BY lt, rt, ra) GROUP BY lt, rt),
    scored AS (SELECT lt AS "left", rt AS "right", round(greatest(there.d, back.d), 6) AS distance
               FROM there JOIN back USING (lt, rt))
    SELECT "left", "right", distance FROM scored {tail}"""


_LABELS = """lab AS (
  SELECT p_type || ' ' || p_name AS type, p_brand || ' ' || p_name AS brand, p_name AS name, p_size, p_partkey AS ordinal FROM part),
ent AS (SELECT type AS key, arg_min(brand, ordinal) AS value FROM lab WHERE p_size > 25 GROUP BY type),
clu AS (SELECT brand AS key, 'cluster-' || CAST(arg_min(p_size, ordinal) AS VARCHAR) AS value FROM lab WHERE p_size > 10 GROUP BY brand)"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL; queries that train a model have none."""
    named = _own_sql()
    if _llm:
        named.update(_llm.oracle_sql())
    if _llm and _pipeline and _pipeline.ORACLE_SQL:
        named["pipeline"] = _pipeline.ORACLE_SQL
    return named


def _own_sql():
    top_by_priority = f"""WITH {_LIC}, typed AS (SELECT {_SQUEEZE_KEY} AS BusinessType, Status, IssuedYear,
        CAST(year(ExpiryDate) AS INTEGER) AS ExpiryYear FROM lic)"""
    words_count = 'SELECT word, count(*) AS "count" FROM ({}) GROUP BY word'
    city_type_grid = f"""(SELECT DISTINCT BusinessType FROM {{0}}) CROSS JOIN (SELECT DISTINCT DataSetOrigin FROM {{0}})
        CROSS JOIN (SELECT unnest(range({FUTURE[0]}, {FUTURE[1] + 1})) AS y)"""
    pivot = ", ".join(
        f"""round(max(CASE WHEN DataSetOrigin = '{r}' AND newest THEN AvgLongevity END) / 365, 2) AS "{r}\"""" for r in REGIONS)
    written = """CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        WHEN 2 THEN upper(strftime(o_orderdate, '%d-%b-%Y')) WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d') END"""
    unknown = """SELECT House, Street, City, Province, Country, PostalCode, LocalArea FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS House, BusinessSubType AS Street, n_name AS City, DataSetOrigin AS Province,
               CAST(NULL AS VARCHAR) AS Country, CAST(n_nationkey AS VARCHAR) AS PostalCode, CAST(NULL AS VARCHAR) AS LocalArea
        FROM lic WHERE Status = 'Pending' AND o_orderkey % 5 <> 0)"""
    return {
        "opens_per_year": f"""WITH {_LIC} SELECT BusinessType, IssuedYear, count(*) AS NumOpens FROM lic
            WHERE Status IN {_ISSUED} GROUP BY ALL""",
        "closes_per_year": f"""WITH {_LIC} SELECT BusinessType, CAST(year(ExpiryDate) AS INTEGER) AS ExpiryYear, count(*) AS NumCloses
            FROM lic WHERE ExpiryDate IS NOT NULL AND Status IN {_CLOSED} GROUP BY ALL""",
        "top_types_opens": f"""WITH {_LIC} SELECT BusinessType, count(*) AS NumBusiness FROM lic WHERE Status IN {_ISSUED}
            GROUP BY ALL ORDER BY NumBusiness DESC, BusinessType LIMIT 5""",
        "top_types_closes": f"""WITH {_LIC} SELECT BusinessType, count(*) AS NumBusiness FROM lic WHERE Status IN {_CLOSED}
            GROUP BY ALL ORDER BY NumBusiness DESC, BusinessType LIMIT 5""",
        "top5_opens_per_year": f"""{top_by_priority} SELECT BusinessType, IssuedYear, count(*) AS NumOpens FROM typed
            WHERE Status IN {_ISSUED} AND BusinessType IN (SELECT BusinessType FROM typed WHERE Status IN {_ISSUED}
              GROUP BY BusinessType ORDER BY count(*) DESC, BusinessType LIMIT 5) GROUP BY ALL""",
        "top5_closes_per_year": f"""{top_by_priority} SELECT BusinessType, ExpiryYear, count(*) AS NumCloses FROM typed
            WHERE ExpiryYear IS NOT NULL AND Status IN {_CLOSED} AND BusinessType IN (SELECT BusinessType FROM typed
              WHERE Status IN {_CLOSED} GROUP BY BusinessType ORDER BY count(*) DESC, BusinessType LIMIT 5) GROUP BY ALL""",
        "longevity_all": _longevity_sql(average="AvgLongevityDays"),
        "longevity_issued": _longevity_sql(f"Status IN {_ISSUED}"),
        "longevity_closed": _longevity_sql(f"Status IN {_CLOSED}"),
        "longevity_issued_by_city": _ISSUED_BY_CITY,
        "longevity_closed_by_city": _longevity_sql(f"Status IN {_CLOSED}", "DataSetOrigin,"),
        "licence_longevity": f"""WITH {_LIC}, aged AS (SELECT o_orderkey, CAST(date_diff('day', IssuedDate,
              least(ExpiryDate, make_date(IssuedYear + 1, 12, 31))) AS INTEGER) AS Longevity FROM lic)
            SELECT o_orderkey, Longevity, CAST(Longevity AS DOUBLE) / 365 AS Years FROM aged""",
        "status_values": f"WITH {_LIC} SELECT DISTINCT Status FROM lic",
        "squeeze_latest": f"WITH {_LIC} {_squeeze_sql(_SQUEEZE_KEY)}",
        "squeeze_no_subtype": f"WITH {_LIC} {_squeeze_sql('BusinessType')}",
        "canonical_projection": f"""WITH {_LIC}, s AS ({_squeeze_sql(_SQUEEZE_KEY)})
            SELECT 'Van' AS DataSetOrigin, BusinessName, LastStatus AS Status, IssueDate AS IssuedDate, ExpiryDate, BusinessType,
                   House || ' ' || Street AS HouseStreet, City || ',' || Province AS CityProvince, PostalCode, Latitude, Longitude FROM s""",
        "register_projection": f"""WITH {_REGISTER} SELECT 'Tor' AS DataSetOrigin, head || ' ' || tail AS BusinessName,
            CASE WHEN expiry IS NULL THEN 'Open' ELSE 'Closed' END AS Status, issued AS IssuedDate,
            coalesce(expiry, '31-DEC-2017') AS ExpiryDate, type AS BusinessType, street AS HouseStreet, city AS CityProvince,
            postal AS PostalCode, CAST(NULL AS DOUBLE) AS Latitude, CAST(NULL AS DOUBLE) AS Longitude FROM reg""",
        "clean_register_dates": f"""WITH {_REGISTER} SELECT head || ' ' || tail AS BusinessName,
            CASE WHEN expiry IS NULL THEN 'Open' ELSE 'Closed' END AS Status, CAST(issued_day AS VARCHAR) AS IssuedDate,
            CAST(expiry_day AS VARCHAR) AS ExpiryDate, CAST(year(issued_day) AS INTEGER) AS IssuedYear,
            CAST(coalesce(year(expiry_day), 0) AS INTEGER) AS ExpiryYear FROM reg
            WHERE day(issued_day) NOT IN (5, 11) AND NOT (expiry IS NULL AND city = 'CHINA')""",
        "parse_dates": f"""WITH w AS (SELECT o_orderkey, {written} AS Written FROM orders),
            p AS (SELECT *, CAST(coalesce(try_strptime(substr(Written, 1, 10), '%Y-%m-%d'), try_strptime(Written, '%d-%b-%Y')) AS DATE) AS d FROM w)
            SELECT o_orderkey, Written, CAST(d AS VARCHAR) AS Parsed, CAST(coalesce(year(d), 0) AS INTEGER) AS Year FROM p""",
        "missing_with_address": f"WITH {_LIC} {unknown}",
        "unknown_count": f"WITH {_LIC} SELECT count(*) AS UnknownAddresses FROM ({unknown})",
        "number_check": """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL AS KIsNumber,
            try_cast(event_type AS DOUBLE) IS NOT NULL AS TypeIsNumber, 
            try_cast('-' || CAST(value AS VARCHAR) || 'e3' AS DOUBLE) IS NOT NULL AS ExponentIsNumber,
            try_cast(json_extract_string(props, '$.k') || ' x' AS DOUBLE) IS NOT NULL AS TailIsNumber FROM events""",
        "cache_fill": f"""WITH {_ADDRESS} SELECT id, a.HouseStreet, a.CityProvince, a.PostalCode,
              CASE WHEN (a.Latitude IS NULL OR a.Longitude IS NULL) AND (c.Latitude <> 0 OR c.Longitude <> 0) THEN c.Latitude ELSE a.Latitude END AS Latitude,
              CASE WHEN (a.Latitude IS NULL OR a.Longitude IS NULL) AND (c.Latitude <> 0 OR c.Longitude <> 0) THEN c.Longitude ELSE a.Longitude END AS Longitude
            FROM ord a LEFT JOIN cache c ON {_SAME}""",
        "cache_upsert": f"""WITH {_ADDRESS} SELECT * FROM cache UNION ALL
            SELECT DISTINCT {_PENDING} FROM ord a WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE {_SAME})""",
        "cache_upsert_append": f"WITH {_ADDRESS} SELECT * FROM cache UNION ALL SELECT {_PENDING} FROM ord a",
        "cache_upsert_replace": f"""WITH {_ADDRESS} SELECT * FROM cache c WHERE NOT EXISTS (SELECT 1 FROM ord a WHERE {_SAME})
            UNION ALL SELECT DISTINCT {_PENDING} FROM ord a""",
        "cache_apply": f"""WITH {_ADDRESS} SELECT c.IsUpdated OR a.c_custkey IS NOT NULL AS IsUpdated, c.HouseStreet, c.CityProvince, c.PostalCode,
              CASE WHEN a.c_custkey IS NOT NULL THEN a.c_acctbal ELSE c.Latitude END AS Latitude,
              CASE WHEN a.c_custkey IS NOT NULL THEN a.c_acctbal / 2 ELSE c.Longitude END AS Longitude
            FROM cache c LEFT JOIN (SELECT * FROM addr WHERE c_mktsegment = 'MACHINERY') a ON {_SAME}""",
        "cache_versions": f"""WITH {_ADDRESS}, every AS (SELECT * FROM cache UNION ALL
              SELECT DISTINCT {_PENDING} FROM ord a WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE {_SAME}))
            SELECT c.IsUpdated OR a.c_custkey IS NOT NULL AS IsUpdated, c.HouseStreet, c.CityProvince, c.PostalCode,
              CASE WHEN a.c_custkey IS NOT NULL THEN a.c_acctbal ELSE c.Latitude END AS Latitude,
              CASE WHEN a.c_custkey IS NOT NULL THEN a.c_acctbal / 2 ELSE c.Longitude END AS Longitude
            FROM every c LEFT JOIN (SELECT * FROM addr WHERE c_mktsegment = 'MACHINERY') a ON {_SAME}""",
        "pending_top_n": f"""WITH {_ADDRESS} SELECT HouseStreet, CityProvince, PostalCode,
              HouseStreet || ' ' || CityProvince || ' ' || PostalCode AS Address FROM cache WHERE NOT IsUpdated
            ORDER BY HouseStreet, CityProvince, PostalCode LIMIT 100""",
        "geocode_pending": f"""WITH {_ADDRESS}, asked AS (SELECT HouseStreet, CityProvince, PostalCode FROM cache WHERE NOT IsUpdated
              ORDER BY HouseStreet, CityProvince, PostalCode LIMIT 50),
            answered AS (SELECT q.*, coalesce(a.c_acctbal, 0.0) AS la, coalesce(a.c_acctbal * 2, 0.0) AS lo, TRUE AS hit
              FROM asked q LEFT JOIN (SELECT * FROM addr WHERE c_acctbal > 0) a USING (HouseStreet, CityProvince, PostalCode))
            SELECT c.IsUpdated OR hit IS NOT NULL AS IsUpdated, c.HouseStreet, c.CityProvince, c.PostalCode,
              CASE WHEN hit THEN la ELSE c.Latitude END AS Latitude, CASE WHEN hit THEN lo ELSE c.Longitude END AS Longitude
            FROM cache c LEFT JOIN answered a ON {_SAME}""",
        "geocode_reply_extract": """WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
            SELECT event_id, CASE WHEN k % 3 = 0 THEN 0.0 ELSE CAST(k AS DOUBLE) END AS Latitude,
                   CASE WHEN k % 3 = 0 THEN 0.0 ELSE -CAST(k AS DOUBLE) END AS Longitude FROM e""",
        "token_counts": f"WITH {_TYPES} " + words_count.format(
            _words_sql("(SELECT * FROM types UNION ALL SELECT * FROM brands)", "BusinessType")),
        "token_counts_documents": words_count.format(_words_sql("documents", "text")),
        "jaccard_pairs": _jaccard_sql("WHERE score >= 0.2"),
        "jaccard_pairs_half": _jaccard_sql("WHERE score >= 0.5"),
        "jaccard_top_n": _jaccard_sql('ORDER BY score DESC, "left", "right" LIMIT 1000'),
        "rwmd_pairs": _rwmd_sql("WHERE distance <= 0.75"),
        "rwmd_top_n": _rwmd_sql('ORDER BY distance, "left", "right" LIMIT 1000'),
        "word_cosine": """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
            FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "first_wins": f"WITH {_LABELS} SELECT type AS key, arg_min(p_size, ordinal) AS value FROM lab GROUP BY type",
        "last_wins": f"WITH {_LABELS} SELECT type AS key, arg_max(p_size, ordinal) AS value FROM lab GROUP BY type",
        "entity_map": f"WITH {_LABELS} SELECT key, value FROM ent",
        "business_types": "SELECT DISTINCT c_mktsegment AS BusinessType FROM orders JOIN customer ON o_custkey = c_custkey",
        "apply_type_map": f"""WITH {_LABELS} SELECT coalesce(clu.value, brand) AS BusinessType, count(*) AS Rows
            FROM lineitem JOIN lab ON l_partkey = ordinal LEFT JOIN clu ON key = brand GROUP BY 1""",
        "unmapped_types": f"WITH {_LABELS}, {_TYPES} SELECT BusinessType FROM brands WHERE BusinessType NOT IN (SELECT key FROM clu)",
        "type_to_cluster": f"""WITH {_LABELS}, {_TYPES} SELECT BusinessType, coalesce(clu.value, '') AS Cluster
            FROM (SELECT * FROM types UNION ALL SELECT * FROM brands) LEFT JOIN ent ON ent.key = BusinessType
            LEFT JOIN clu ON clu.key = coalesce(ent.value, BusinessType)""",
        "vocab_union": f"WITH {_TYPES} SELECT * FROM types UNION SELECT * FROM brands",
        "vocab_append": f"""WITH {_LABELS} SELECT DISTINCT name AS BusinessType FROM lab UNION ALL SELECT DISTINCT type FROM lab
            UNION ALL SELECT DISTINCT name FROM lab""",
        "merged_vocabulary": f"""WITH {_LABELS}, {_TYPES} SELECT DISTINCT coalesce(value, BusinessType) AS BusinessType
            FROM (SELECT * FROM types UNION ALL SELECT * FROM brands) LEFT JOIN ent ON key = BusinessType""",
        "future_grid": f"WITH {_LIC} SELECT BusinessType, DataSetOrigin, CAST(y AS INTEGER) AS year FROM {city_type_grid.format('lic')}",
        "future_counts": f"""WITH hist AS ({_ISSUED_BY_CITY}), grid AS (SELECT * FROM {city_type_grid.format('hist')}),
            latest AS (SELECT DataSetOrigin, BusinessType, arg_max(NumBusiness, year) AS n FROM hist GROUP BY ALL),
            mean AS (SELECT DataSetOrigin, avg(NumBusiness) AS m FROM hist GROUP BY ALL)
            SELECT CAST(y AS INTEGER) AS year, BusinessType, DataSetOrigin, coalesce(CAST(n AS DOUBLE), m) AS NumBusiness
            FROM grid LEFT JOIN latest USING (DataSetOrigin, BusinessType) LEFT JOIN mean USING (DataSetOrigin)""",
        "stability_pivot": f"""WITH hist AS ({_ISSUED_BY_CITY}), marked AS (SELECT *,
              year = max(year) OVER (PARTITION BY DataSetOrigin, BusinessType) AS newest FROM hist)
            SELECT lower(BusinessType) AS BusinessType, {pivot} FROM marked GROUP BY 1""",
        "stability_bands": f"""WITH hist AS ({_ISSUED_BY_CITY}), r AS (SELECT *, round(AvgLongevityYears, 2) AS Years FROM hist)
            SELECT DataSetOrigin, year, BusinessType, Years, CASE WHEN least(floor(Years + 0.5), 15) < 5 THEN 'red'
              WHEN least(floor(Years + 0.5), 15) < 10 THEN 'yellow' ELSE 'green' END AS Band FROM r""",
        "error_metrics": f"""WITH {_LIC}, aged AS (SELECT BusinessType, IssuedYear, date_diff('day', IssuedDate,
              least(ExpiryDate, make_date(IssuedYear + 1, 12, 31))) AS d FROM lic),
            scored AS (SELECT BusinessType, d, CAST(sum(d) OVER w AS DOUBLE) / count(*) OVER w AS p FROM aged WHERE d > 0
              WINDOW w AS (PARTITION BY BusinessType, IssuedYear))
            SELECT BusinessType, count(*) AS n, round(sqrt(avg((p - d) * (p - d))), 6) AS rmse, round(avg(abs(p - d)), 6) AS mae
            FROM scored GROUP BY BusinessType""",
    } | _more_sql()


def _more_sql():
    """SQL of the deterministic steps of training and of the small rules."""
    def by_frequency(column):
        return f"(SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i FROM hist GROUP BY {column})"

    sign = "o_orderstatus = 'O'"
    quoted = "('\"' || p_name || '\", \"' || p_type || '\",' || p_brand)"

    def years(region):
        return f"round(max(CASE WHEN DataSetOrigin = '{region}' AND year = {FUTURE[1]} THEN prediction END) / 365, 2)"

    told = ", ".join(f"""{years(r)} AS "{r}", CASE WHEN {years(r)} IS NULL THEN NULL WHEN least(floor({years(r)} + 0.5), 15) < 5 THEN 'red'
        WHEN least(floor({years(r)} + 0.5), 15) < 10 THEN 'yellow' ELSE 'green' END AS "{r}Band\"""" for r in REGIONS)
    return {
        "regression_sums": _ridge_sql('SELECT CAST(fold AS INTEGER) AS fold, i AS "row", j AS "column", round(s, 4) AS total FROM sums WHERE round(s, 4) <> 0'),
        "fit_ridge": _ridge_sql("SELECT DataSetOrigin, year, BusinessType, NumBusiness, AvgLongevity, prediction FROM fitted"),
        "predict_ridge": _ridge_sql("SELECT year, BusinessType, DataSetOrigin, NumBusiness, prediction FROM told"),
        "ridge_report": _ridge_sql(f"SELECT lower(BusinessType) AS BusinessType, {told} FROM told GROUP BY 1"),
        "ridge_metrics": _ridge_sql("""SELECT DataSetOrigin, count(*) AS n, round(sqrt(avg((prediction - AvgLongevity) * (prediction - AvgLongevity))), 3) AS rmse,
              round(avg(abs(prediction - AvgLongevity)), 3) AS mae FROM fitted GROUP BY DataSetOrigin"""),
        "feature_vectors": f"""WITH hist AS ({_ISSUED_BY_CITY}),
            f AS (SELECT hist.*, c.i AS ci, t.i AS ti, (SELECT count(DISTINCT BusinessType) FROM hist) AS kinds
              FROM hist JOIN {by_frequency('DataSetOrigin')} c USING (DataSetOrigin) JOIN {by_frequency('BusinessType')} t USING (BusinessType)),
            g AS (SELECT *, sqrt(ci * ci + CASE WHEN ti < kinds - 1 THEN 1 ELSE 0 END + CAST(year AS DOUBLE) * year
              + CAST(NumBusiness AS DOUBLE) * NumBusiness) AS long FROM f)
            SELECT DataSetOrigin, BusinessType, year, NumBusiness, ci AS DataSetOriginIndex, ti AS BusinessTypeIndex,
              CAST(CASE WHEN ti < kinds - 1 THEN ti + 1 ELSE 0 END AS INTEGER) AS HotSlot, round(ci / long, 9) AS CityPart,
              round(year / long, 9) AS YearPart, round(NumBusiness / long, 9) AS NumberPart FROM g""",
        "type_vectors": f"""WITH {_TYPES}, w AS ({_words_sql('types', 'BusinessType')}),
            vec AS (SELECT word, CAST(embedding AS DOUBLE[]) AS v FROM (SELECT DISTINCT word FROM w)
              JOIN embeddings ON vec_id = CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings)),
            parts AS (SELECT t, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM w JOIN vec USING (word)),
            mean AS (SELECT t, k, sum(x) / (SELECT count(*) FROM w AS own WHERE own.t = parts.t) AS x FROM parts GROUP BY t, k)
            SELECT t AS BusinessType, round(max(x) FILTER (k = 1), 6) AS First, round(max(x) FILTER (k = 2), 6) AS Second,
              round(sqrt(sum(x * x)), 6) AS Length FROM mean GROUP BY t""",
        "cluster_given_vectors": f"""WITH {_TYPES}, w AS ({_words_sql('types', 'BusinessType')}),
            vec AS (SELECT word, CAST(embedding AS DOUBLE[]) AS v FROM (SELECT DISTINCT word FROM w)
              JOIN embeddings ON vec_id = CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % (SELECT count(*) FROM embeddings)),
            parts AS (SELECT t, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM w JOIN vec USING (word)),
            mean AS (SELECT t, k, sum(x) / (SELECT count(*) FROM w AS own WHERE own.t = parts.t) AS x FROM parts GROUP BY t, k),
            typed AS (SELECT t, list(x ORDER BY k) AS v FROM mean GROUP BY t),
            c0 AS (SELECT row_number() OVER (ORDER BY md5(t), t) - 1 AS c, v AS cv
              FROM (SELECT v, min(t) AS t FROM typed GROUP BY v) ORDER BY md5(t), t LIMIT 12),
            {_LLOYD.format(at=0, next=1)}, {_LLOYD.format(at=1, next=2)}
            SELECT t AS BusinessType, CAST(arg_min(c, list_distance(v, cv)) AS INTEGER) AS cluster FROM typed CROSS JOIN c2 GROUP BY t""",
        "nearest_cluster": """SELECT e.vec_id, arg_min(c.vec_id, list_distance(CAST(e.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))) AS cluster
            FROM embeddings e CROSS JOIN (SELECT * FROM embeddings WHERE vec_id < 30) c GROUP BY e.vec_id""",
        "near_vectors": """SELECT a.vec_id AS near, b.vec_id FROM embeddings a CROSS JOIN embeddings b
            WHERE list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) <= 0.9""",
        "licences_of_city": f"WITH {_LIC} SELECT o_orderkey, DataSetOrigin, Status FROM lic WHERE DataSetOrigin = 'ASIA'",
        "cache_fill_six_keys": f"""SELECT o_orderkey AS id, c_name AS House,
              CASE WHEN NOT ({sign}) AND c_acctbal > 0 THEN c_acctbal WHEN o_orderstatus <> 'P' THEN o_totalprice END AS Latitude,
              CASE WHEN NOT ({sign}) AND c_acctbal > 0 THEN -c_acctbal WHEN {sign} THEN -o_totalprice END AS Longitude
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "quote_rules": f"""SELECT p_partkey, translate({quoted}, '\"', ' ') AS NoQuotes, translate({quoted}, ',\"', '  ') AS NoSeparators,
              replace({quoted}, '\"', '') AS Dropped, replace(replace({quoted}, '\"', ''), ',', ' ') AS Draft FROM part""",
        "year_from_name": """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2017 ELSE year(o_orderdate) END AS INTEGER) AS Year
            FROM orders""",
        "most_frequent_words": f"""SELECT word, count(*) AS "count" FROM ({_words_sql('documents', 'text')}) GROUP BY word
            ORDER BY "count" DESC, word LIMIT 100""",
        "largest_groups_by_year": f"""SELECT year, BusinessType, NumBusiness FROM ({_longevity_sql(f"Status IN {_ISSUED}")})
            ORDER BY year, NumBusiness DESC, BusinessType LIMIT 20""",
        "merged_licences": f"""WITH {_LIC}, s AS ({_squeeze_sql(_SQUEEZE_KEY)}), reg AS (
              SELECT c_mktsegment AS type, ' ' || c_name || ' ' AS tail, strftime(o_orderdate, '%d-%b-%Y') AS issued,
                     CAST(o_orderkey AS VARCHAR) AS head, o_orderpriority AS street, n_name AS city, CAST(n_nationkey AS VARCHAR) AS postal,
                     CASE WHEN o_orderstatus <> 'O' THEN strftime(shipped, '%d-%b-%Y') END AS expiry
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN ship ON l_orderkey = o_orderkey)
            SELECT 'Van' AS DataSetOrigin, BusinessName, LastStatus AS Status, IssueDate AS IssuedDate, ExpiryDate, BusinessType,
                   House || ' ' || Street AS HouseStreet, City || ',' || Province AS CityProvince, PostalCode, Latitude, Longitude FROM s
            UNION ALL SELECT 'Tor', head || ' ' || tail, CASE WHEN expiry IS NULL THEN 'Open' ELSE 'Closed' END, issued,
                   coalesce(expiry, '31-DEC-2017'), type, street, city, postal, NULL, NULL FROM reg""",
    }
