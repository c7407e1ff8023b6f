"""Business-type vocabularies: distinct types, word counts, label maps and their application."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permitry.functions.text import is_token, tokens, words
from permitry.schemas import STOP_WORDS
from permitry.session import cut


def business_types(df, column="BusinessType"):
    """The distinct types of a table as one column ``BusinessType``."""
    return df.select(F.col(column).alias("BusinessType")).distinct()


def append_types(*vocabularies):
    """All vocabularies one after the other, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), vocabularies)


def union_types(*vocabularies):
    """Types that occur in any of the vocabularies, once each."""
    return append_types(*vocabularies).distinct()


def token_table(df, column="BusinessType", stop_words=STOP_WORDS):
    """One row per text: its tokens (``text``) next to the original (``business``).

    Stop words are a list, or a table ``word`` of any length.
    """
    if not isinstance(stop_words, DataFrame):
        return df.select(tokens(column, stop_words).alias("text"), F.col(column).alias("business"))
    rows = df.select(tokens(column, ()).alias("__all"), F.col(column).alias("business"))
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    spread = rows.select("business", "__row", F.posexplode_outer("__all").alias("__place", "word"))
    kept = spread.join(stop_words.select("word", F.lit(True).alias("__stop")), "word", "left")
    place = F.when(F.col("__stop").isNull() & F.col("word").isNotNull(), F.struct("__place", "word"))
    texts = kept.groupBy("__row").agg(F.array_sort(F.collect_list(place)).alias("__kept"), F.first("business").alias("business"))
    return texts.select(F.col("__kept.word").alias("text"), "business")


def word_counts(df, column="BusinessType", stop_words=STOP_WORDS):
    """How often each word occurs; repeats inside one text count. Sort at the sink.

    Stop words are a list, or a table ``word`` of any length.
    """
    found = df.select(F.explode(words(column)).alias("word"))
    if isinstance(stop_words, DataFrame):
        counted = found.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        return counted.join(stop_words.select("word"), "word", "left_anti")
    found = found.where(is_token(F.col("word"), stop_words))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def by_count(counts):
    return counts.orderBy(F.desc("count"), "word")


def _wins(df, key, value, ordinal, pick):
    return df.groupBy(F.col(key).alias("key")).agg(pick(F.col(value), F.col(ordinal)).alias("value"))


def first_wins(df, key, value, ordinal="ordinal"):
    """One ``value`` per ``key``: the one with the smallest ordinal."""
    return _wins(df, key, value, ordinal, F.min_by)


def last_wins(df, key, value, ordinal="ordinal"):
    """One ``value`` per ``key``: the one with the largest ordinal."""
    return _wins(df, key, value, ordinal, F.max_by)


def entity_map(labels, key="BusinessType2", value="BusinessType1", label="IsMatch(Yes/No)", ordinal="ordinal"):
    """Matched types from labelled pairs: the first pair labelled exactly ``Yes`` for each key."""
    return first_wins(labels.where(F.col(f"`{label}`") == "Yes"), key, value, ordinal)


def cluster_map(labels, key="type", value="cluster_name", ordinal="ordinal"):
    """Cluster name of each type, the first label of a type wins."""
    return first_wins(labels, key, value, ordinal)


def type_map(rows, key="type", value="cluster_name", ordinal="ordinal"):
    """Cluster name of each type, the last row of a type wins."""
    return last_wins(rows, key, value, ordinal)


def _mapped(df, column, mapping, name):
    table = mapping.select(F.col("key").alias(column), F.col("value").alias(name), F.lit(True).alias(f"{name}_hit"))
    return df.join(table, column, "left")


def _keep_or(df, column, name, otherwise):
    hit = F.coalesce(F.col(f"{name}_hit"), F.lit(False))
    return F.when(hit, F.col(name)).otherwise(otherwise)


def replace_types(df, mapping, column="BusinessType"):
    """Rows with ``column`` replaced by its mapped value; unmapped values stay."""
    joined = _mapped(df, column, mapping, "__mapped")
    return joined.withColumn(column, _keep_or(joined, column, "__mapped", F.col(column))).select(df.columns)


def unmapped_rows(df, mapping, column="BusinessType"):
    """Rows whose ``column`` has no entry in the map: the report next to ``replace_types``."""
    return df.join(mapping.select(F.col("key").alias(column)), column, "left_anti").select(df.columns)


def replaced_and_unmapped(df, mapping, column="BusinessType", keep=cut):
    """Both of the above from one join: it is written out once with a mark for each row, both tables are read from it."""
    joined = _mapped(df, column, mapping, "__mapped")
    marked = keep(joined.select(
        *[F.col(c) for c in df.columns], _keep_or(joined, column, "__mapped", F.col(column)).alias("__replaced"),
        F.coalesce(F.col("__mapped_hit"), F.lit(False)).alias("__hit")))
    replaced = marked.withColumn(column, F.col("__replaced")).select(df.columns)
    return replaced, marked.where(~F.col("__hit")).select(df.columns)


def merged_vocabulary(vocabulary_a, vocabulary_b, entities):
    """Both vocabularies with matched types replaced, once each."""
    return union_types(replace_types(vocabulary_a, entities), replace_types(vocabulary_b, entities))


def type_to_cluster(types, entities, clusters, column="BusinessType"):
    """Each type with the cluster of its entity; types without a cluster get the empty text."""
    entity = _mapped(types, column, entities, "__entity")
    with_entity = entity.withColumn("__type", _keep_or(entity, column, "__entity", F.col(column))).select(
        F.col(column).alias("__original"), F.col("__type").alias(column)
    )
    joined = _mapped(with_entity, column, clusters, "__cluster")
    return joined.select(
        F.col("__original").alias(column), _keep_or(joined, column, "__cluster", F.lit("")).alias("Cluster"),
    )
