"""File readers. CSV cells are text unless a schema says otherwise; doubled quotes are understood."""

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.functions.dates import year_from_file_name
from permitry.functions.text import drop_quotes
from permitry.operators.clean import clean_licences
from permitry.operators.vocabulary import business_types
from permitry.schemas import (
    ADDRESS_KEYS, PREDICTIONS, REGISTER, SNAPSHOT_TEXT, address_cache,
)

_RAW = "_raw_record"


def _csv(spark, multi_line=False, **options):
    """CSV reader. ``multi_line`` allows line breaks inside quotes, at the price of unsplittable files."""
    return spark.read.options(escape='"', multiLine=multi_line, **options)


def read_csv(spark, path, schema=None, multi_line=False):
    """CSV with a header; all text without a schema, columns by position with one."""
    reader = _csv(spark, multi_line, header=True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_snapshots(spark, path):
    """Merged yearly snapshots by column name, coordinates and year as numbers."""
    table = read_csv(spark, path)
    numbers = {"Latitude": "double", "Longitude": "double", "YearRecorded": "int"}
    return table.withColumns({c: F.col(c).try_cast(kind) for c, kind in numbers.items() if c in table.columns})


def read_register(spark, path):
    """The positional register; its header is skipped and names are ignored."""
    return read_csv(spark, path, REGISTER)


def read_licences(spark, path, **cleaning):
    """Canonical licences from a header CSV, cleaned for the statistics."""
    return clean_licences(read_csv(spark, path), **cleaning)


def read_business_types(spark, path_a, path_b):
    """The distinct business types of both final tables."""
    return business_types(read_csv(spark, path_a)), business_types(read_csv(spark, path_b))


def _headers(spark, folder, pattern):
    """Header lines of a folder's files with the files that have them: one job over the files' first blocks."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    first = lines.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), F.struct(F.monotonically_increasing_id().alias("row"), "value").alias("line"))
    headers = first.groupBy("path").agg(F.min("line.row").alias("row"), F.min("line").alias("line"))
    grouped = headers.groupBy(F.col("line.value").alias("header")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    # the paths come as web addresses
    return [(row["header"], [unquote(path) for path in row["paths"]]) for row in grouped.orderBy("header").collect()]


def _more_than_one_field(first_columns):
    """Rows of at least two fields. Short rows carry their raw text; a comma outside quotes tells."""
    outside_quotes = F.regexp_replace(_RAW, '"[^"]*"', "")
    any_other = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in first_columns[1:]], F.lit(False))
    return any_other | F.col(_RAW).isNull() | outside_quotes.contains(",")


def read_yearly_snapshots(spark, folder, default_year, pattern="*.csv", comma_to_space=False, multi_line=False):
    """All yearly files of a folder by column name, with the year their name starts with.

    Files are grouped by header, each group is read in one scan, and missing columns become NULL. Rows of
    a single field are dropped, double quotes deleted; the draft form also turns commas into spaces.
    """
    def group(header, paths):
        layout = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _RAW)])
        rows = (
            _csv(spark, multi_line, header=True, columnNameOfCorruptRecord=_RAW, mode="PERMISSIVE")
            .schema(layout).csv(paths)
        )
        kept = rows.where(_more_than_one_field(header)) if len(header) > 1 else rows.limit(0)
        year = year_from_file_name("_metadata.file_name", default_year)
        cells = [drop_quotes(F.col(f"`{c}`"), comma_to_space).alias(c) for c in header]
        return kept.select(*cells, year.alias("YearRecorded"))

    tables = [group(next(csv.reader([header])), paths) for header, paths in _headers(spark, folder, pattern)]
    if not tables:
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def typed_snapshots(df, columns=SNAPSHOT_TEXT):
    """Snapshot columns in their usual order, absent ones NULL, coordinates as numbers."""
    def cell(c):
        text = F.col(c) if c in df.columns else F.lit(None).cast("string")
        return (text.try_cast("double") if c in ("Latitude", "Longitude") else text).alias(c)

    return df.select(*[cell(c) for c in columns], "YearRecorded")


def read_stop_words(spark, path):
    """Stop words, one a line, as a table ``word``; ``word_counts`` and ``token_table`` take it of any length."""
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("word")).distinct()


def with_ordinal(df):
    """Adds ``ordinal``: the place of a row in its files (name, block, row), larger is later."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.withColumn("ordinal", place)


def read_labels(spark, path, columns, multi_line=False):
    """Headerless label or map file with the given column names and an ``ordinal``."""
    layout = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return with_ordinal(_csv(spark, multi_line, header=False).schema(layout).csv(path))


def read_entity_labels(spark, path):
    return read_labels(spark, path, ["BusinessType1", "BusinessType2", "IsMatch(Yes/No)"])


def read_cluster_labels(spark, path):
    return read_labels(spark, path, ["type", "number", "cluster_name"])


def read_type_map(spark, path):
    """Written type map; an unmapped type has the empty text, which CSV reads as NULL."""
    return read_labels(spark, path, ["type", "cluster_name"]).fillna("", ["cluster_name"])


def read_predictions(spark, path, lines=False):
    """Published predictions with an ``ordinal``: a JSON array, or with ``lines`` a record a line."""
    return with_ordinal(spark.read.schema(PREDICTIONS).option("multiLine", not lines).json(path))


def read_word_vectors(spark, path):
    """Word vectors ``(word, vec)`` from parquet."""
    return spark.read.schema("word string, vec array<float>").parquet(path)


def newest_version(spark, path):
    """Number of the newest version in a cache folder, None without any; only the folder's own names are listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [one.getPath().getName() for one in files.listStatus(place)] if files.exists(place) else []
    return max((int(found[1]) for found in (re.fullmatch(r"version=(\d+)", name) for name in names) if found), default=None)


def read_address_cache(spark, path, keys=ADDRESS_KEYS):
    """The newest version of the address cache; versions are told by the names of their folders."""
    newest = newest_version(spark, path)
    if newest is None:
        raise FileNotFoundError(f"no version of an address cache in {path}")
    return spark.read.schema(address_cache(keys)).parquet(f"{path}/version={newest}")


def read_replies(spark, path, keys=ADDRESS_KEYS):
    """Geocoder replies: JSON lines with the address keys and the body of the ``reply`` as text."""
    return spark.read.schema(", ".join(f"{c} string" for c in (*keys, "reply"))).json(path)
