"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is an aggregate and a join on node keys; a node with very many links is pre-aggregated in each task,
and Spark's skew join splits its rows. Every round is a written table, so a lost executor repeats one round.
"""

from pyspark.sql import functions as F

from permitry.session import written


def _state(edges):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges):
    """Rows (node, root) for every node of the pairs ``edges``; root is the smallest node reachable from it."""
    a, b = (F.col(name) for name in edges.columns)
    edges = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct())
    before, now = None, _state(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")).select("e.*").where("a <> b").distinct()
        edges = written(small)
        before, now = now, _state(edges)
    roots = edges.select("b").distinct()
    return edges.unionByName(roots.select(F.col("b").alias("a"), "b")).toDF("node", "root")
