"""Zipped yearly snapshots as a data source with one partition for each member of each archive."""

import csv
import fnmatch
import io
import json
import sys
import zipfile
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from permitry.functions.dates import year_from_file_name
from permitry.functions.text import drop_quotes
from permitry.schemas import SNAPSHOT_TEXT

MEMBER = "__member"
#: Records and characters of a batch that goes to Spark; a single longer record is a batch of its own.
BATCH, CHARS = 4096, 4 << 20
#: Archives whose directories are read at the same time, and the bytes of one read.
LISTERS, READ = 32, 1 << 20


@dataclass
class Member(InputPartition):
    """A member of an archive: where the archive is, the name in it, its size unpacked."""

    archive: str
    name: str
    size: int


def _located(uri):
    """File system and path of an absolute address, given as Hadoop writes it (nothing is escaped)."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, path = rest.removeprefix("//").partition("/")
    files, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return files, f"{root.rstrip('/')}/{path}"


def _opened(files, place):
    return io.BufferedReader(files.open_input_file(place), READ)


def _names(files, place):
    """The members of one archive; only its directory is read."""
    with _opened(files, place) as raw:
        # pyarrow refuses the search for a directory in front of the file's start
        if raw.seek(0, io.SEEK_END) <= zipfile.sizeEndCentDir:
            return []
        archive = zipfile.ZipFile(raw)
        return [Member(place, one.filename, one.file_size) for one in archive.infolist() if not one.is_dir()]


def batches(raw, name, columns):
    """Record batches of one member: its base name and the wanted cells of each record, read as a stream.

    Cells are cut by ``csv``, so a quote opens a quoted run only at the start of a cell. An empty cell is None,
    also one in quotes, and so is a column that the header lacks; of two columns of one name the first counts. Records of a single cell are none, a member without a header has no records.
    """
    csv.field_size_limit(sys.maxsize)
    kind = pa.schema([(c, pa.string()) for c in (MEMBER, *columns)])
    base = name.rsplit("/", 1)[-1]

    def batch(rows):
        return pa.record_batch([pa.array(cells, pa.string()) for cells in zip(*rows)], schema=kind)

    with zipfile.ZipFile(raw) as archive, archive.open(name) as packed:
        text = io.TextIOWrapper(packed, "utf-8-sig", errors="replace", newline="")
        records = (r for r in csv.reader(text) if r)
        header = next(records, [])
        spots = [header.index(c) if c in header else sys.maxsize for c in columns]
        rows, held = [], 0
        for record in records:
            if len(record) < 2:
                continue
            rows.append((base, *[(record[s] or None) if s < len(record) else None for s in spots]))
            held += sum(map(len, filter(None, rows[-1])))
            if len(rows) >= BATCH or held >= CHARS:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)


class _MemberReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.pattern, self.columns = options["path"], options["pattern"], json.loads(options["columns"])

    def partitions(self):
        files, place = _located(self.folder)
        found = files.get_file_info(place)
        if found.type == fs.FileType.Directory:
            inside = files.get_file_info(fs.FileSelector(place))
            archives = [f.path for f in inside if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern)]
        else:
            archives = [place] if found.is_file else []
        if not archives:
            raise FileNotFoundError(f"no {self.pattern} files in {self.folder}")
        with ThreadPoolExecutor(LISTERS) as pool:
            members = [m for listed in pool.map(lambda a: _names(files, a), archives) for m in listed]
        # the largest start first, so that none of them is waited for at the end
        return sorted(members, key=lambda m: (-m.size, m.archive, m.name))

    def read(self, partition):
        # an archive without members
        if isinstance(partition, Member):
            files, _ = _located(self.folder)
            with _opened(files, partition.archive) as raw:
                yield from batches(raw, partition.name, self.columns)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members")`` with the options ``path``, ``pattern`` and ``columns`` (a JSON list)."""

    @classmethod
    def name(cls):
        return "zip_members"

    def schema(self):
        return T.StructType([T.StructField(c, T.StringType()) for c in (MEMBER, *json.loads(self.options["columns"]))])

    def reader(self, schema):
        return _MemberReader(dict(self.options))


def _qualified(spark, path):
    """The path with the scheme and place of its file system, which a worker cannot know."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def read_zip_members(spark, folder, default_year, columns=SNAPSHOT_TEXT, pattern="*.zip", comma_to_space=False):
    """Yearly snapshots from the zip archives of a folder, or from one archive, in the form of the CSV reader.

    Each member is a task that reads its own byte range of the archive as a stream, so archives and members may be of
    any size and headers of any width; all header layouts are one scan. A member itself cannot be split. The file
    system must be one that pyarrow opens (local or mounted, HDFS, S3, GCS, ABFS).
    """
    spark.dataSource.register(ZipMembers)
    options = {"path": _qualified(spark, folder), "pattern": pattern, "columns": json.dumps(list(columns))}
    rows = spark.read.format("zip_members").options(**options).load()
    cells = [drop_quotes(F.col(f"`{c}`"), comma_to_space).alias(c) for c in columns]
    return rows.select(*cells, year_from_file_name(MEMBER, default_year).alias("YearRecorded"))
