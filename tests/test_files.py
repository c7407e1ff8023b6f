"""Readers and writers."""

import csv
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from permitry.operators import vocabulary
from permitry.plans.ingest import ingest
from permitry.schemas import LICENCE, SNAPSHOT_TEXT, STOP_WORDS, address_cache
from permitry.sinks import writers
from permitry.sources import archives, readers

HEADER = ",".join(SNAPSHOT_TEXT)


def line(**cells):
    return ",".join(cells.get(c, "") for c in SNAPSHOT_TEXT)


@pytest.fixture
def folder(tmp_path):
    """Yearly files: quotes, a reordered header, short rows, a single field, a file without a year."""
    place = tmp_path / "yearly files"
    place.mkdir()
    (place / "2010 business.csv").write_text("\n".join([
        HEADER, line(BusinessName='"Ann ""A"" Spa, Ltd"', BusinessType="Spa", IssuedDate="2010-01-05", Latitude="49.5"),
        "only", '"one, field"', "Short,Bar,x", line(BusinessName="Allblank"), "",
    ]) + "\n")
    (place / "2011business.csv").write_text("\n".join([
        "BusinessType,BusinessName,Extra", "Law,Bob,e", "Bar,,", ",,",
    ]) + "\n")
    (place / "latest.csv").write_text(f"{HEADER}\n{line(BusinessName='Cat', Status='Open')}\n")
    return place


EXPECTED = [
    (2010, "Allblank", None, None), (2010, "Ann A Spa, Ltd", "Spa", 49.5), (2010, "Short", "Bar", None),
    (2011, None, None, None), (2011, None, "Bar", None), (2011, "Bob", "Law", None), (2017, "Cat", None, None),
]


def test_yearly_snapshots(spark, rows, folder):
    found = ingest(spark, str(folder), 2017, zipped=False)
    assert found.columns == [*SNAPSHOT_TEXT, "YearRecorded"]
    assert rows(found, "YearRecorded", "BusinessName", "BusinessType", "Latitude") == EXPECTED
    assert rows(found, "BusinessName", "BusinessSubType")[-1][0] == "Short"
    assert dict(rows(found, "BusinessName", "BusinessSubType"))["Short"] == "x"


def test_yearly_snapshots_keep_other_columns(spark, folder):
    found = readers.read_yearly_snapshots(spark, str(folder), 2017)
    assert "Extra" in found.columns
    assert [r.Extra for r in found.where("BusinessName = 'Bob'").collect()] == ["e"]


def test_draft_turns_commas_into_spaces(spark, folder):
    found = readers.read_yearly_snapshots(spark, str(folder), 2017, comma_to_space=True)
    assert "Ann A Spa  Ltd" in {r.BusinessName for r in found.collect()}


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_yearly_snapshots(spark, str(tmp_path), 2017)


def test_zipped_snapshots(spark, rows, folder, tmp_path):
    packed = tmp_path / "zip"
    packed.mkdir()
    with zipfile.ZipFile(packed / "a.zip", "w") as archive:
        archive.write(folder / "2010 business.csv", "sub/2010 business.csv")
        archive.write(folder / "2011business.csv", "2011business.csv")
    with zipfile.ZipFile(packed / "b.zip", "w") as archive:
        archive.write(folder / "latest.csv", "latest.csv")
    found = ingest(spark, str(packed), 2017)
    assert rows(found, "YearRecorded", "BusinessName", "BusinessType", "Latitude") == EXPECTED
    plain = ingest(spark, str(folder), 2017, zipped=False)
    assert rows(found) == rows(plain)


@pytest.mark.parametrize("size", [5, 12, 1000])
def test_zip_records_across_blocks(size, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", size)
    records = ['Ann,"1\n2"', "B,", '"a ""b"", c",x', "single", '"line\r\nbreak",y']
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        archive.writestr("sub/2012.csv", "\r\n".join(["BusinessName,City", *records]) + "\r\n\r\n")
        archive.writestr("empty.csv", "")
    found = list(archives.member_blocks(content.getvalue()))
    assert [r for _, _, block in found for r in block] == records
    assert {(name, tuple(header)) for name, header, _ in found} == {("2012.csv", ("BusinessName", "City"))}


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_zip_quotes_inside_cells(size, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", size)
    rng = random.Random(size)
    texts = ['A,B\n12" Pizza,V\nNext,W\n6" Sub,5"\n"x, ""y""\n2",z\nLast,"u"v"w\n', 'A,B\nc,d\n"open,1\ne,f\n']
    texts += ["A,B\n" + "".join(rng.choice('aab"",,\n') for _ in range(40)) for _ in range(150)]
    for text in texts:
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            archive.writestr("2012.csv", text)
        found = [r for _, _, block in archives.member_blocks(content.getvalue()) for r in block]
        cells = [next(csv.reader(io.StringIO(r, newline=""))) for r in found]
        assert cells == [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]


def test_zip_lone_quotes(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("2012.csv", 'BusinessName,City\n12" Pizza,V\nBob,W\n6" Sub,5" X\n12" alone\n"one, cell"\n"A, ""B""",Z\nEnd,Y\n')
    found = archives.read_zipped_snapshots(spark, str(tmp_path), 2017, ["BusinessName", "City"])
    assert sorted((r.BusinessName, r.City) for r in found.collect()) == [
        ("12 Pizza", "V"), ("6 Sub", "5 X"), ("A, B", "Z"), ("Bob", "W"), ("End", "Y")]


def test_zip_draft_and_width(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("2012.csv", 'BusinessName,City\n"A, ""B""",V\n')
    found = archives.read_zipped_snapshots(spark, str(tmp_path), 2017, ["BusinessName"], comma_to_space=True)
    assert [r.BusinessName for r in found.collect()] == ["A  B"]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("2012.csv", ",".join([f"c{i}" for i in range(archives.WIDTH + 1)]) + "\n1,2\n")
    with pytest.raises(Exception, match="wanted column"):
        archives.read_zipped_snapshots(spark, str(tmp_path), 2017, [f"c{archives.WIDTH}"]).collect()


def test_zip_members_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 7)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("2012.csv", "\n".join(["BusinessName,City", *[f"N{i},V" for i in range(10)]]))
    found = archives.read_zipped_snapshots(spark, str(tmp_path), 2017, ["City", "BusinessName", "Status"])
    assert found.count() == 10
    assert {tuple(r)[0] for r in found.collect()} == {"V"} and found.where("Status IS NULL").count() == 10


def test_read_snapshots_types(spark, tmp_path):
    (tmp_path / "m.csv").write_text("BusinessName,Latitude,YearRecorded\nAnn,49.5,2010\nBob,x,\n")
    found = readers.read_snapshots(spark, str(tmp_path / "m.csv")).collect()
    assert [tuple(r) for r in found] == [("Ann", 49.5, 2010), ("Bob", None, None)]


def test_register_by_position(spark, tmp_path):
    header = ",".join(f"H{i}" for i in range(18))
    cells = [f"v{i}" for i in range(18)]
    cells[4] = '"a ""quoted"" name"'
    (tmp_path / "r.csv").write_text(header + "\n" + ",".join(cells) + "\n")
    found = readers.read_register(spark, str(tmp_path / "r.csv")).first()
    assert found.c4 == 'a "quoted" name' and found.c15 == "v15" and len(found) == 16


def licences(spark):
    return spark.createDataFrame([
        ("Van", "Ann, Ltd", "Open", "2010-01-05", None, 'Spa "x"', "1 Main", "V,BC", "V1", 49.5, -123.0),
        ("Tor", "Bob", "Closed", "05-JAN-2010", "2012-02-03", "Bar", "2 Main", "T", "M1", None, None)], LICENCE)


def test_licences_round_trip(spark, rows, tmp_path):
    out = str(tmp_path / "lic")
    writers.write_rows(licences(spark), out, "csv")
    found = readers.read_licences(spark, out)
    assert rows(found, "BusinessName", "BusinessType", "IssuedYear", "ExpiryYear") == [
        ("Ann, Ltd", 'Spa "x"', 2010, None), ("Bob", "Bar", 2010, 2012)]
    a, b = readers.read_business_types(spark, out, out)
    assert rows(a) == rows(b) == [("Bar",), ('Spa "x"',)]
    writers.write_rows(licences(spark), str(tmp_path / "p"))
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == rows(licences(spark))


def test_final_tables(spark, tmp_path):
    writers.write_final(licences(spark).coalesce(1), str(tmp_path / "f"))
    text = next((tmp_path / "f").glob("part*")).read_text().splitlines()
    assert text[0].startswith('"DataSetOrigin","BusinessName"') and text[1].startswith('"Van","Ann, Ltd"')
    writers.write_final_by_origin(licences(spark), str(tmp_path / "o"))
    assert {p.name for p in (tmp_path / "o").iterdir() if p.is_dir()} == {"DataSetOrigin=Van", "DataSetOrigin=Tor"}


def test_single_file(spark, tmp_path):
    data = spark.range(100).repartition(5)
    writers.write_csv(data, str(tmp_path / "many"))
    writers.write_csv(data, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part*"))) == 1
    assert spark.read.csv(str(tmp_path / "many"), header=True).count() == 100
    writers.write_metric(data, str(tmp_path), "all", "ids")
    writers.write_metric(data, str(tmp_path), "all", "ids")
    assert spark.read.csv(str(tmp_path / "all" / "ids"), header=True).count() == 100


def test_clusters(spark, rows, tmp_path):
    data = spark.createDataFrame([("Spa, Day", 1), ("Bar", 0)], "business string, cluster int")
    writers.write_clusters(data, str(tmp_path / "c"))
    assert rows(spark.read.csv(str(tmp_path / "c"), escape='"')) == [("Bar", "0"), ("Spa, Day", "1")]
    writers.write_cluster_lines(data, str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("Bar,0",), ("Spa, Day,1",)]


def test_candidates_and_labels(spark, rows, tmp_path):
    ranked = spark.createDataFrame([("Spa", "Day Spa", 0.5), ("Bar", "Pub", 0.2)], "left string, right string, score double")
    writers.write_candidates(ranked.orderBy(F.desc("score")), str(tmp_path / "c"), 1)
    back = spark.read.csv(str(tmp_path / "c"), header=True)
    assert back.columns == ["BusinessType1", "BusinessType2", "IsMatch(Yes/No)"]
    assert rows(back) == [("Spa", "Day Spa", None)]


def test_label_order_follows_files(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("Cab,Taxi,Yes\nLimo,Taxi,Yes\n")
    (tmp_path / "b.csv").write_text('Bus,Taxi,Yes\n"Gym, Big",Club,Yes\n')
    found = readers.read_entity_labels(spark, str(tmp_path)).repartition(4)
    assert rows(vocabulary.entity_map(found)) == [("Club", "Gym, Big"), ("Taxi", "Cab")]
    assert rows(vocabulary.last_wins(found, "BusinessType2", "BusinessType1")) == [("Club", "Gym, Big"), ("Taxi", "Bus")]


def test_cluster_labels_and_type_map(spark, rows, tmp_path):
    (tmp_path / "c.csv").write_text("Cab,3,Transport\nCab,3,Other\n")
    clusters = vocabulary.cluster_map(readers.read_cluster_labels(spark, str(tmp_path / "c.csv")))
    assert rows(clusters) == [("Cab", "Transport")]
    entities = spark.createDataFrame([("Taxi", "Cab")], "key string, value string")
    types = spark.createDataFrame([("Taxi",), ("Bar",)], "BusinessType string")
    writers.write_type_map([types, types.limit(0)], entities, clusters, str(tmp_path / "m"))
    assert rows(vocabulary.type_map(readers.read_type_map(spark, str(tmp_path / "m")))) == [("Bar", ""), ("Taxi", "Transport")]


def test_stop_words(spark, tmp_path):
    (tmp_path / "s.txt").write_text("\n".join(STOP_WORDS) + "\n")
    table = readers.read_stop_words(spark, str(tmp_path / "s.txt"))
    assert sorted(r.word for r in table.collect()) == sorted(set(STOP_WORDS))
    texts = spark.createDataFrame([("The car and the Car wash",), ("of the",), (None,), ("x car x",)], "BusinessType string")
    for count in (vocabulary.word_counts, vocabulary.token_table):
        assert sorted(map(str, count(texts, stop_words=table).collect())) == sorted(map(str, count(texts).collect()))


def test_predictions(spark, rows, tmp_path):
    records = [{"BusinessType": "Spa", "City": "Van", "Year": 2017, "Stability": 365.0},
               {"BusinessType": "SPA", "City": "Van", "Year": 2017, "Stability": 730.0}]
    (tmp_path / "p.json").write_text(json.dumps(records, indent=2))
    found = readers.read_predictions(spark, str(tmp_path / "p.json"))
    writers.write_predictions(found, str(tmp_path / "out"), single_file=True)
    again = readers.read_predictions(spark, str(tmp_path / "out"), lines=True)
    assert rows(again.drop("ordinal")) == rows(found.drop("ordinal"))
    assert rows(found, "BusinessType", "Year", "Stability") == [("SPA", 2017, 730.0), ("Spa", 2017, 365.0)]
    assert found.orderBy("ordinal").first().Stability == 365.0


def test_word_vectors(spark, tmp_path):
    spark.createDataFrame([("spa", [1.0, 2.0])], "word string, vec array<float>").write.parquet(str(tmp_path / "v"))
    assert readers.read_word_vectors(spark, str(tmp_path / "v")).first().vec == [1.0, 2.0]


def test_cache_versions(spark, rows, tmp_path):
    path = str(tmp_path / "cache")
    first = spark.createDataFrame([(False, "1 Main", "V", "V1", None, None)], address_cache())
    writers.write_address_cache(first, path, 1)
    newer = readers.read_address_cache(spark, path).withColumn("IsUpdated", F.lit(True))
    writers.write_address_cache(newer, path, 2)
    assert rows(readers.read_address_cache(spark, path)) == [(True, "1 Main", "V", "V1", None, None)]
    with pytest.raises(Exception, match="already exists"):
        writers.write_address_cache(first, path, 2)
