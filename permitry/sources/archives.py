"""Zipped yearly snapshots."""

import csv
import io
import re
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from permitry.functions.dates import year_from_file_name
from permitry.functions.text import drop_quotes
from permitry.schemas import SNAPSHOT_TEXT

BLOCK = 1 << 20
#: Cells of a record that are parsed; a wanted column further right is refused.
WIDTH = 128
#: As in csv.reader a quote opens a quoted run only as the first character of a cell.
_CELL = re.compile(r'"[^"]*(?:""[^"]*)*(?:"[^,\r\n]*)?|[^",\r\n][^,\r\n]*')
_RECORD = re.compile(rf'(?:{_CELL.pattern}|,)+')


def _cut(block):
    """Records of a block that are surely complete, as they end before it does, and the rest."""
    records, last = [], None
    for last in _RECORD.finditer(block):
        records.append(last.group())
    if last and last.end() == len(block):
        return records[:-1], block[last.start():]
    return records, ""


def member_blocks(content):
    """Blocks of records of every CSV member of a zip archive: member name, header cells and a list of records.

    Members are decoded as they are read, a megabyte at a time; line breaks inside quotes belong to the record.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            if name.endswith("/"):
                continue
            with archive.open(name) as raw:
                text, header, held = io.TextIOWrapper(raw, "utf-8", errors="replace", newline=""), None, ""
                # a record of many blocks is read again for twice the text only
                while chunk := text.read(max(BLOCK, len(held))):
                    records, held = _cut(held + chunk)
                    if records and header is None:
                        header = next(csv.reader([records.pop(0)]))
                    if records:
                        yield name.rsplit("/", 1)[-1], header, records
                records = _RECORD.findall(held)
                if records and header is not None:
                    yield name.rsplit("/", 1)[-1], header, records


def read_zipped_snapshots(spark, folder, default_year, columns=SNAPSHOT_TEXT, pattern="*.zip", comma_to_space=False):
    """Yearly snapshots straight from the zip archives of a folder, in the form of the CSV reader.

    Archives are spread over the tasks and only cut into records there; Spark parses the records. An archive cannot be
    split, and one of more than 2 GB cannot be read as a file of bytes: unpack such a one first.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("content")

    def unzip(frames):
        for frame in frames:
            for content in frame["content"]:
                for member, header, records in member_blocks(content):
                    spots = [header.index(c) + 1 if c in header else 0 for c in columns]
                    if max(spots) > WIDTH:
                        raise ValueError(f"{member} has a wanted column behind the first {WIDTH}")
                    # a record of a single cell is none
                    records = [r for r in records if not ((cell := _CELL.match(r)) and cell.end() == len(r))]
                    yield pd.DataFrame({"member": member, "spots": [spots] * len(records), "record": records})

    rows = archives.mapInPandas(unzip, "member string, spots array<int>, record string")
    layout = ", ".join(f"_{i} string" for i in range(WIDTH))
    cells = F.from_csv("record", layout, {"escape": '"', "mode": "PERMISSIVE"})
    parsed = rows.withColumn("cells", cells).withColumn("cells", F.array(*[F.col(f"cells._{i}") for i in range(WIDTH)]))
    year = year_from_file_name("member", default_year)
    wanted = []
    for i, name in enumerate(columns, 1):
        spot = F.element_at("spots", i)
        wanted.append(drop_quotes(F.when(spot > 0, F.element_at("cells", F.greatest(spot, F.lit(1)))), comma_to_space).alias(name))
    return parsed.select(*wanted, year.alias("YearRecorded"))
