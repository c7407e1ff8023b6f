"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space; their SHA-256
stands for them. Of equal texts the row with the smallest id stays.

1. Frequent digests: ``approx_top_k``, a Misra-Gries summary (DataSketches' frequent items), over 64 bits of the
   digest. Tasks' summaries are merged in groups, so no task merges all of them.
2. Verified winners: rows of those digests are counted exactly, with pre-aggregation in each task. A digest
   that holds at least one in ``SHARE`` rows is hot; there can be no more than ``SHARE`` of them, which bounds the
   broadcast.
3. Map side: rows of hot digests meet their winner by broadcast and are never shuffled.
4. The rest: count and smallest row by digest, pre-aggregated in each task, joined back to the rows.

A hot digest that the summary should miss takes the ordinary way, with the same result.

Defined cases: NULL text counts as empty; a NULL id comes after all others; among rows of equal text and equal
id (repeated rows) one stays; an empty table gives an empty result; all other columns are carried along
untouched, whatever their names.
"""

from pyspark.sql import functions as F

from permitry.llm.rows import numbered
from permitry.session import written

SHARE = 1000
TRACKED = 4096
MERGERS = 256


def normalised(text):
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _summary(rows, total):
    """64-bit keys that may hold one in ``SHARE`` rows; half the share is asked for, as summaries undercount."""
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")
    tops = rows.groupBy(merger).agg(F.explode(F.expr(f"approx_top_k(key, {TRACKED // 2}, {TRACKED})")).alias("top"))
    counted = tops.groupBy(F.col("top.item").alias("key")).agg(F.sum("top.count").alias("n"))
    return counted.where((F.col("n") > 1) & (F.col("n") * 2 * SHARE >= total)).select("key")


def _smallest_first():
    """Smallest id with its row; a NULL id last."""
    return F.min(F.struct(F.isnull("id").alias("none"), "id", "row")).alias("first")


def verdicts(rows):
    """Rows (row, id, digest) of a written table with keep_id, group_size and kept added."""
    total = rows.count()
    rows = rows.withColumn("key", F.xxhash64("digest"))
    likely = rows.join(_summary(rows, total), "key", "left_semi")
    grouped = likely.groupBy("digest").agg(F.count("*").alias("group_size"), _smallest_first())
    winners = written(grouped.where((F.col("group_size") > 1) & (F.col("group_size") * SHARE >= total)))
    hot = rows.join(F.broadcast(winners), "digest")
    others = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    counted = others.groupBy("digest").agg(F.count("*").alias("group_size"), _smallest_first())
    rest = others.join(counted.where(F.col("group_size") > 1), "digest", "left")
    alone = F.isnull("group_size")
    return hot.unionByName(rest).select(
        "row", "id", F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"), "digest")


def _digests(numbered_rows, id_column, text_column):
    """Written rows (row, id, digest): the texts are read once."""
    digest = F.sha2(normalised(F.col(f"doc.`{text_column}`")), 256).alias("digest")
    return written(numbered_rows.select("row", F.col(f"doc.`{id_column}`").alias("id"), digest))


def find_copies(docs, id_column="doc_id", text_column="text"):
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    found = verdicts(_digests(numbered(docs, [id_column, text_column]), id_column, text_column))
    return found.select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(docs, id_column="doc_id", text_column="text"):
    """The documents that stay, with all their columns."""
    rows = numbered(docs)
    dropped = verdicts(_digests(rows, id_column, text_column)).where(~F.col("kept")).select("row")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
