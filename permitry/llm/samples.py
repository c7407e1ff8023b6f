"""Training rows: a bounded, reproducible sample of labelled documents in shards of bounded size."""

from pyspark.sql import functions as F

SAMPLE = 16_000
SHARD = 4_000


def held_out(id_column):
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 4 == 2


def training_rows(docs, labels, label, id_column="doc_id", text_column="text", sample=SAMPLE):
    """Rows (id, text, label, shard) of at most ``sample`` labelled documents that are not held out.

    Those with the smallest hash of their id are taken; rows without id or label are not. One row for each id. A
    shard has about ``SHARD`` rows, so a task that learns from one shard has bounded work. The sampled labels are
    broadcast: at most ``sample`` ids.
    """
    known = labels.select(F.col(id_column).alias("id"), label.alias("label")).where("id is not null and label is not null")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.max(F.struct("label", "text")).alias("row"))
    shards = F.greatest(F.lit(1), F.round(F.lit(known.count()) / SHARD).cast("int"))
    shards = F.least(shards, F.lit(max(1, sample // SHARD)))
    return rows.select("id", "row.text", "row.label", F.pmod(F.xxhash64("id", F.lit(7)), shards).alias("shard"))
