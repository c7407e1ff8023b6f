"""Every job from files to files, and the package away from its folder."""

import os
import subprocess
import sys
import zipfile

import pytest

from permitry import jobs
from permitry.sources import readers

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = ("BusinessName,BusinessType,BusinessSubType,Status,IssuedDate,ExpiredDate,House,Street,City,Province,Country,PostalCode,"
          "Latitude,Longitude,LocalArea")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("jobs")
    (place / "raw").mkdir()
    kinds = ("Day Spa", "Wine Bar", "Law Office")
    for year in (2001, 2002):
        lines = [f"Shop{i},{kinds[i % 3]},,Issued,{year}-0{1 + i % 9}-02,,{i},Main,V,BC,CA,V{i},49.{i},-123.{i},L" for i in range(20)]
        (place / "raw" / f"{year}shops.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    with zipfile.ZipFile(place / "raw" / "all.zip", "w") as archive:
        for year in (2001, 2002):
            archive.write(place / "raw" / f"{year}shops.csv", f"{year}shops.csv")
    cells = ["t", "tail", "", "05-Feb-2003", "head", "", "", "1 King", "Toronto,ON", "M1", "", "", "", "", "", ""]
    rows = []
    for i in range(12):
        own = list(cells)
        own[0], own[1], own[4] = ("Spa Day", "Wine Bar", "Clinic")[i % 3], f"tail{i}", f"head{i}"
        own[15] = "" if i % 2 else "06-Mar-2009"
        rows.append(",".join(f'"{c}"' for c in own))
    (place / "register.csv").write_text("\n".join([",".join(f"c{i}" for i in range(16)), *rows]) + "\n")
    return place


def test_jobs(spark, folder):
    at = str(folder)
    jobs.main(["ingest", "--input", f"{at}/raw", "--out", f"{at}/snapshots"])
    jobs.main(["ingest", "--input", f"{at}/raw", "--zipped", "--out", f"{at}/unzipped"])
    snapshots = readers.read_snapshots(spark, f"{at}/snapshots")
    assert snapshots.count() == readers.read_snapshots(spark, f"{at}/unzipped").count() == 40

    jobs.main(["clean", "--input", f"{at}/snapshots", "--cache", f"{at}/cache", "--out", f"{at}/a"])
    jobs.main(["clean", "--input", f"{at}/register.csv", "--register", "--cache", f"{at}/cache", "--cache-version", "1", "--out", f"{at}/b"])
    assert readers.read_csv(spark, f"{at}/a").count() == 20 and readers.read_csv(spark, f"{at}/b").count() == 12
    assert readers.read_address_cache(spark, f"{at}/cache").count() >= 1

    both = ["--a", f"{at}/a", "--b", f"{at}/b"]
    jobs.main(["candidates", *both, "--n", "5", "--out", f"{at}/pairs"])
    pairs = readers.read_csv(spark, f"{at}/pairs").collect()
    assert {(r[0], r[1]) for r in pairs} == {("Spa Day", "Day Spa"), ("Wine Bar", "Wine Bar")}
    (folder / "labels.csv").write_text("Day Spa,Spa Day,Yes\nWine Bar,Wine Bar,Yes\n")
    jobs.main(["clusters", *both, "--labels", f"{at}/labels.csv", "--k", "2", "--out", f"{at}/clusters"])
    clusters = readers.read_cluster_labels(spark, f"{at}/clusters").collect()
    assert {r["type"] for r in clusters} >= {"Clinic"}
    (folder / "named.csv").write_text("Day Spa,0,Beauty\nClinic,1,Health\n")
    jobs.main(["map-types", *both, "--labels", f"{at}/labels.csv", "--clusters", f"{at}/named.csv", "--out", f"{at}/map"])
    jobs.main(["finish", *both, "--map", f"{at}/map", "--out", f"{at}/final"])
    final = spark.read.option("header", True).csv(f"{at}/final/licences")
    assert final.count() == 32 and {"Health"} <= {r["BusinessType"] for r in final.collect()}

    final.write.option("header", True).csv(f"{at}/whole")
    jobs.main(["trends", "--input", f"{at}/whole", "--out", f"{at}/trends"])
    assert readers.read_predictions(spark, f"{at}/trends/predictions", lines=True).count() > 0
    assert readers.read_csv(spark, f"{at}/trends/statistics/all/opens_per_year").count() > 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The package is found by the driver alone; its functions reach the workers by value."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from permitry.session import local_session
spark = local_session(2, 2, "1g")
from permitry.operators import similarity
types = lambda *names: spark.createDataFrame([(n,) for n in names], "BusinessType string")
words = spark.createDataFrame([("spa", [1.0, 0.0]), ("bar", [0.0, 1.0]), ("day", [0.9, 0.1])], "word string, vec array<float>")
found = similarity.relaxed_pairs(types("Spa", "Bar"), types("Day Spa", "Bar"), words, within=0.5)
print("pairs", sorted(map(tuple, found.select("left", "right").collect())))
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "pairs [('Bar', 'Bar'), ('Spa', 'Day Spa')]" in done.stdout, done.stderr[-2000:]
