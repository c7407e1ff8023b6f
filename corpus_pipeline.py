"""A training corpus from the table of documents: five stages, each a table that the next one reads.

Defined cases, for every stage: NULL texts count as empty and stay (the exact stage keeps one of the empty texts, the
substring stage gives them as empty texts); rows with a NULL id are documents like others; of repeated rows the exact stage
keeps one; an empty table gives an empty table; other columns are carried along untouched, whatever their names, up to
the last stage, and ``n_chars`` is counted anew where it is there. Documents of any length are read as a whole.
"""

from pyspark.sql import functions as F

from permitry.llm import exact, ngram_join, packing, queries, substrings, toxicity
from permitry.session import tune, written


def drop_toxic(spark, docs, sf_dir):
    tune(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark, docs, sf_dir):
    tune(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    tune(spark)
    return ngram_join.keep_one(docs)


def drop_shared_passages(spark, docs, sf_dir):
    """Texts without passages that occur elsewhere; their lengths, where there are any, are counted anew."""
    tune(spark)
    cut = substrings.drop_passages(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark, docs, sf_dir):
    tune(spark)
    return packing.pack(docs, queries.tokenizer())


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_shared_passages), ("best_fit_packing", pack),
]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Packed pieces of the documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
