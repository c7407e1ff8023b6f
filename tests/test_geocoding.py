"""Geocoding from files to files, and resolvers in several tasks."""

import json

import pytest
from pyspark.sql import functions as F

from permitry import jobs
from permitry.operators import address
from permitry.schemas import address_cache
from permitry.sinks import writers
from permitry.sources import readers


def test_pending_addresses_are_asked_and_written_back(spark, tmp_path):
    at = str(tmp_path)
    rows = [(False, f"{i} Main", "V,BC", "P", None, None) for i in range(6)] + [(True, "known", "", "", 1.0, 2.0)]
    cache = spark.createDataFrame(rows, address_cache())
    for version in (2, 10):
        writers.write_address_cache(cache, f"{at}/cache", version)
    jobs.main(["pending", "--cache", f"{at}/cache", "--n", "4", "--out", f"{at}/asked"])
    asked = [r.asDict() for r in spark.read.json(f"{at}/asked").orderBy("HouseStreet").collect()]
    assert [r["HouseStreet"] for r in asked] == [f"{i} Main" for i in range(4)] and asked[0]["Address"]
    place = {"query": {"count": 1, "results": {"place": {"centroid": {"latitude": "5", "longitude": "-6"}}}}}
    replies = [{**r, "reply": json.dumps(place if i else {"query": {"count": 0, "results": None}})} for i, r in enumerate(asked)]
    (tmp_path / "replies.json").write_text("\n".join(map(json.dumps, replies)))
    jobs.main(["geocoded", "--cache", f"{at}/cache", "--replies", f"{at}/replies.json", "--out", f"{at}/cache"])
    assert readers.newest_version(spark, f"{at}/cache") == 11
    found = readers.read_address_cache(spark, f"{at}/cache")
    assert found.where("IsUpdated").count() == 5 and found.where("Latitude = 5 AND Longitude = -6").count() == 3
    assert address.pending_addresses(found, 10).count() == 2


def test_no_version(spark, tmp_path):
    assert readers.newest_version(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        readers.read_address_cache(spark, str(tmp_path))


def test_a_function_runs_in_several_tasks(spark):
    rows = [(False, f"{i} Main", "V,BC", "P", None, None) for i in range(60)]
    cache = spark.createDataFrame(rows, address_cache())
    resolver = address.function_resolver(lambda frame: frame.drop(columns="Address").assign(Latitude=1.0, Longitude=2.0), tasks=4)
    asked = resolver(address.pending_addresses(cache, 50))
    assert asked.select(F.spark_partition_id()).distinct().count() > 1
    assert address.geocode_pending(cache, resolver, 50).where("Latitude = 1").count() == 50
