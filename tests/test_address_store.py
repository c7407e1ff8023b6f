"""The address cache in buckets and deltas."""

import os

import pytest

from permitry.operators import address
from permitry.operators.address_store import AddressStore, VersionConflict
from permitry.schemas import address_cache


def cache(spark, rows):
    return spark.createDataFrame(rows, address_cache())


@pytest.fixture
def store(spark, tmp_path):
    made = AddressStore(spark, str(tmp_path / "store"))
    made.create(cache(spark, [(True, f"{i} Main", "V,BC", "P", 1.0 + i, 2.0) for i in range(40)]
                      + [(False, "x", "", "", None, None), (False, None, "", "", None, None)]), buckets=8)
    return made


def asked(spark, *streets):
    return spark.createDataFrame([(s, "V,BC", "P") for s in streets], "HouseStreet string, CityProvince string, PostalCode string")


def geocodes(spark, *found):
    return spark.createDataFrame([(s, "V,BC", "P", a, b) for s, a, b in found],
                                 "HouseStreet string, CityProvince string, PostalCode string, Latitude double, Longitude double")


def test_as_on_a_plain_table(spark, rows, store):
    plain, seen = store.read(), [store.read().count()]
    new, late = asked(spark, "1 Main", "new", "new", None), asked(spark, "2 Main", "other")
    found = geocodes(spark, ("new", 5.0, 6.0), ("new", 0.0, 0.0), ("3 Main", 7.0, 8.0), ("unknown", 1.0, 1.0))
    assert [store.insert(new), store.apply(found), store.insert(late, "replace")] == [2, 3, 4]
    plain = address.apply_geocodes(address.insert_addresses(plain, new), found)
    plain = address.insert_addresses(plain, late, "replace")
    wanted = rows(plain.select(store.schema.names))
    assert rows(store.read()) == wanted
    before = store._state(4)
    assert store.compact() == 5 and rows(store.read()) == wanted
    after = store._state(5)
    assert after["deltas"] == [] and store.read(1).count() == seen[0]
    assert sum(after["base"][b] != before["base"].get(b) for b in after["base"]) <= 5
    assert store.compact() == 5


def test_an_update_writes_what_it_changes(spark, store):
    base = store._state(1)["base"]
    store.apply(geocodes(spark, ("3 Main", 7.0, 8.0)))
    table, = store._state(2)["deltas"]
    assert store._rows([f"{store.path}/data/{table}"]).count() == 1
    store.compact()
    moved = [b for b, where in store._state(3)["base"].items() if where != base[b]]
    assert len(moved) == 1 and len(base) > 2


def test_one_of_two_writers_fails(spark, store):
    other = AddressStore(spark, store.path)

    def slow(cache):
        other.insert(asked(spark, "first"))
        return cache.limit(0)

    with pytest.raises(VersionConflict):
        store._update(slow)
    assert store.versions() == [1, 2] and store.read().where("HouseStreet = 'first'").count() == 1
    with pytest.raises(VersionConflict):
        store.create(store.read())
    # a writer that was lost behind its claim
    open(f"{store.path}/versions/3", "w").close()
    assert store.read().where("HouseStreet = 'first'").count() == 1
    with pytest.raises(VersionConflict):
        store.insert(asked(spark, "second"))
    os.remove(f"{store.path}/versions/3")
    assert store.insert(asked(spark, "second")) == 3


def test_deltas_are_compacted(spark, store):
    store.deltas = 2
    for i in range(4):
        store.insert(asked(spark, f"n{i}"))
    assert len(store._latest()[1]["deltas"]) <= 2 and store.read().where("HouseStreet LIKE 'n%'").count() == 4


def test_empty_and_missing(spark, tmp_path):
    made = AddressStore(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        made.read()
    with pytest.raises(FileNotFoundError):
        made.insert(asked(spark, "a"))
    with pytest.raises(ValueError):
        made.insert(asked(spark, "a"), "append")
    made.create(cache(spark, []))
    assert made.read().count() == 0 and made.insert(asked(spark, "a")) == 2 and made.read().count() == 1
