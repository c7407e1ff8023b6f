"""The many-to-many join under heavy keys gives the same rows as a plain join."""

import re

import pytest
from pyspark.sql import functions as F

from permitry.operators.skew import grid_join, key_parts


@pytest.mark.parametrize("cell", [5, 40, 10_000])
def test_grid_join(spark, rows, cell):
    a = spark.range(300).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20).alias("ka"))
    b = spark.range(200).select(F.col("id").alias("b"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 15).alias("kb"))
    condition = (F.col("a") + F.col("b")) % 2 == 0
    plain = a.join(b, (F.col("ka") == F.col("kb")) & condition)
    found = grid_join(a, b, "ka", "kb", condition, cell)
    assert found.columns == plain.columns and rows(found) == rows(plain)


def test_every_heavy_key_gets_cells(spark):
    """More heavy keys than any list would hold, on both sides."""
    keys = spark.range(1500).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6))))
    a = keys.select(F.col("id").alias("ka"), F.col("copy").alias("a"))
    b = keys.select(F.col("id").alias("kb"), F.col("copy").alias("b"))
    parts = key_parts(a, b, "ka", "kb", 2).collect()
    assert len(parts) == 1500 and all((r["__rows"], r["__columns"]) == (3, 3) for r in parts)
    assert grid_join(a, b, "ka", "kb", F.lit(True), 2).count() == 1500 * 36


def test_no_exchange_by_the_key_alone(spark):
    a = spark.range(500).select(F.col("id").alias("a"), (F.col("id") % 3).alias("ka"))
    b = spark.range(400).select(F.col("id").alias("b"), (F.col("id") % 3).alias("kb"))
    plan = grid_join(a, b, "ka", "kb", F.lit(True), 10)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and all(len([c for c in e.split(",") if "#" in c]) > 1 for e in exchanges)
