"""Clustering of business types by their mean word vector."""

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from permitry.functions.vectors import euclidean
from permitry.operators.vocabulary import token_table
from permitry.schemas import STOP_WORDS
from permitry.session import cut

# Number of clusters and length of the word vectors.
CLUSTERS = 30
VECTOR_SIZE = 300


def fit_word_vectors(token_rows, vector_size=VECTOR_SIZE, seed=42, partitions=None):
    """Word vectors learnt from token lists, by default in as many parts as the rows have."""
    partitions = partitions or token_rows.rdd.getNumPartitions()
    learner = Word2Vec(
        vectorSize=vector_size, minCount=0, seed=seed, numPartitions=partitions, inputCol="text", outputCol="result",
    )
    return learner.fit(token_rows)


def vector_table(model):
    """The learnt vectors as a ``(word, vec)`` table."""
    found = model.getVectors()
    return found.select("word", vector_to_array("vector").alias("vec"))


def mean_vectors(token_rows, vectors):
    """Mean of the given vectors ``(word, vec)`` over a text's tokens, unknown ones counting as zero: ``(business, vec)``.

    Texts without any known word are left out.
    """
    words = token_rows.select("business", F.size("text").alias("__size"), F.explode("text").alias("word"))
    parts = words.join(vectors, "word").select("business", "__size", F.posexplode("vec").alias("__at", "__x"))
    sums = parts.groupBy("business", "__size", "__at").agg((F.sum("__x") / F.col("__size")).alias("__x"))
    listed = sums.groupBy("business").agg(F.array_sort(F.collect_list(F.struct("__at", "__x"))).alias("__all"))
    return listed.select("business", F.col("__all.__x").alias("vec"))


def nearest_centre(rows, centres, vector="vec"):
    """Adds ``cluster``: the number of the nearest of the given centres ``(cluster, centre)``, the first of equal ones.

    Centres are the few of a clustering; Spark decides whether to broadcast them.
    """
    numbered = centres.agg(F.array_sort(F.collect_list(F.struct("cluster", "centre")))).scalar()
    away = F.transform("__centres", lambda c: F.struct(euclidean(F.col(vector), c["centre"]).alias("away"), c["cluster"].alias("cluster")))
    return rows.withColumn("__centres", numbered).withColumn("cluster", F.array_min(away)["cluster"]).drop("__centres")


def first_centres(rows, k):
    """Up to ``k`` different vectors to start from, those whose first text has the smallest MD5 sums: ``(cluster, centre)``."""
    different = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("business").alias("business"))
    order = F.struct(F.md5("business").alias("sum"), "business")
    chosen = different.select(order.alias("order"), "vec").orderBy("order").limit(k)
    listed = chosen.agg(F.array_sort(F.collect_list(F.struct("order", "vec"))).alias("all"))
    return listed.select(F.posexplode("all").alias("cluster", "one")).select("cluster", F.col("one.vec").alias("centre"))


def moved_centres(assigned, centres):
    """Centres moved to the mean of their rows, as sums that tasks add up before the shuffle; one without rows stays.

    All vectors have the length of the centres.
    """
    length = len((centres.select("centre").first() or [[]])[0])
    count = F.count(F.lit(1))
    parts = [F.sum(F.element_at("vec", i + 1).cast("double")) / count for i in range(length)]
    means = assigned.groupBy("cluster").agg(F.array(*parts).alias("__mean"))
    return centres.join(means, "cluster", "left").select(
        "cluster", F.coalesce("__mean", F.col("centre").cast("array<double>")).alias("centre"))


def cluster_vectors(rows, k=CLUSTERS, rounds=20):
    """Clusters of ``(business, vec)`` by k-means from ``first_centres``: ``(business, cluster)``.

    Every round is one pass that reads the rows and moves ``k`` centres; it ends after ``rounds`` or when no centre
    moves. Rows without a vector have no cluster, equal distances go to the smaller number, and an empty table gives
    an empty result. The outcome does not depend on partitions but for the rounding of sums.
    """
    rows = cut(rows.select("business", "vec"))
    centres = cut(first_centres(rows, k))
    for _ in range(rounds):
        moved = cut(moved_centres(nearest_centre(rows.where("vec IS NOT NULL"), centres), centres))
        old = centres.select("cluster", F.col("centre").cast("array<double>").alias("old"))
        still = moved.join(old, "cluster").where(F.col("centre") != F.col("old")).isEmpty()
        centres = moved
        if still:
            break
    return nearest_centre(rows, centres).select("business", F.when(F.col("vec").isNotNull(), F.col("cluster")).alias("cluster"))


def cluster_types(types, k=CLUSTERS, column="BusinessType", vector_size=VECTOR_SIZE, stop_words=STOP_WORDS,
                  seed=42, partitions=None, vectors=None, rounds=20):
    """Cluster number of each type: mean word vector, then k-means. Sort by cluster at the sink.

    The tokens are written out once, training passes over them several times. With a table of ``vectors``
    ``(word, vec)`` nothing is trained and the clusters are those of ``cluster_vectors``; types without a known word
    have none.
    """
    if vectors is not None:
        tokens = token_table(types, column, stop_words).where("business IS NOT NULL")
        return cluster_vectors(mean_vectors(tokens, vectors), k, rounds)
    rows = cut(token_table(types, column, stop_words).where("business IS NOT NULL"))
    embedded = fit_word_vectors(rows, vector_size, seed, partitions).transform(rows)
    model = KMeans(featuresCol="result", k=k, predictionCol="cluster", seed=seed).fit(embedded)
    return model.transform(embedded).select("business", "cluster")
