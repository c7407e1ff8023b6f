"""Zip archives read member by member."""

import csv
import io
import random
import zipfile

import pytest

from permitry.plans.ingest import ingest
from permitry.sources import members


def packed(texts, compression=zipfile.ZIP_STORED):
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", compression) as archive:
        for name, text in texts.items():
            archive.writestr(name, text)
    content.seek(0)
    return content


def cells(content, name, columns):
    return [tuple(r.values()) for b in members.batches(content, name, columns) for r in b.to_pylist()]


def test_a_task_for_each_member(spark, tmp_path):
    for half in (0, 1):
        texts = {f"sub/{2000 + i}.csv": f"BusinessName,City\nN{i},V\n\nsingle\n" for i in range(half, 20, 2)}
        (tmp_path / f"half {half}.zip").write_bytes(packed(texts).getvalue())
    (tmp_path / "other.txt").write_text("x")
    found = members.read_zip_members(spark, str(tmp_path), 2017, ["BusinessName", "City", "Status"])
    assert found.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, found.collect())) == sorted((f"N{i}", "V", None, 2000 + i) for i in range(20))
    one = members.read_zip_members(spark, str(tmp_path / "half 1.zip"), 2017, ["BusinessName"])
    assert one.count() == 10


def test_as_whole_archives(spark, rows, tmp_path):
    texts = {
        "2010 a.csv": 'BusinessName,City,Latitude\n"A, ""B""",V,49.5\n12" Pizza,,x\n"",W\n"one, cell"\n"line\r\nbreak",y,\n',
        "b.csv": "City,Extra,BusinessName\nV,e,Bob\n,,\n", "empty.csv": "", "2011header.csv": "BusinessName,City\n", "2012.csv": "\n\n",
    }
    (tmp_path / "a.zip").write_bytes(packed(texts, zipfile.ZIP_DEFLATED).getvalue())
    found = ingest(spark, str(tmp_path), 2017)
    assert found.count() == 6
    assert rows(found) == rows(ingest(spark, str(tmp_path), 2017, whole_archives=True))
    draft = members.read_zip_members(spark, str(tmp_path), 2017, ["BusinessName"], comma_to_space=True)
    assert "A  B" in {r.BusinessName for r in draft.collect()}


def test_random_texts_as_csv():
    rng = random.Random(3)
    texts = {f"{i}.csv": "A,B\n" + "".join(rng.choice('aab"",,\n') for _ in range(40)) for i in range(200)}
    content = packed(texts)
    for name, text in texts.items():
        wanted = [(name, r[0] or None, r[1] or None) for r in list(csv.reader(io.StringIO(text, newline="")))[1:] if len(r) > 1]
        assert cells(content, name, ["A", "B"]) == wanted


def test_wide_headers_long_cells_and_marks(monkeypatch):
    names = [f"c{i}" for i in range(500)]
    long = "x" * 300_000
    text = "﻿" + ",".join(names) + "\n" + ",".join(["first", *["1"] * 498, long]) + "\nshort,2\n"
    found = cells(packed({"a/w.csv": text}), "a/w.csv", ["c499", "c0", "none"])
    assert found == [("w.csv", long, "first", None), ("w.csv", None, "short", None)]
    twice = cells(packed({"w.csv": b"A,A,B\n1,2,\xff\n"}), "w.csv", ["A", "B"])
    assert twice == [("w.csv", "1", "�")]
    monkeypatch.setattr(members, "BATCH", 3)
    many = packed({"w.csv": "A,B\n" + "1,2\n" * 10})
    assert [b.num_rows for b in members.batches(many, "w.csv", ["A"])] == [3, 3, 3, 1]


def test_members_are_streamed():
    class Counted(io.BytesIO):
        seen = 0

        def read(self, n=-1):
            got = super().read(n)
            self.seen += len(got)
            return got

    content = Counted(packed({"2012.csv": "A,B\n" + "abcdefgh,ijklmnop\n" * 1_000_000}).getvalue())
    first = next(members.batches(content, "2012.csv", ["B"]))
    assert first.num_rows == members.BATCH and content.seen < 1 << 20


def test_no_archives(spark, tmp_path):
    with pytest.raises(Exception, match="no .* files"):
        members.read_zip_members(spark, str(tmp_path), 2017).collect()
    (tmp_path / "a.zip").write_bytes(packed({}).getvalue())
    assert members.read_zip_members(spark, str(tmp_path), 2017).count() == 0
