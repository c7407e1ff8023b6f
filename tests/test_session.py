"""Where intermediate tables go."""

import os

from pyspark.sql import functions as F

from permitry import session


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = session.shared_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    rows = session.written(spark.range(10).withColumn("odd", F.col("id") % 2 == 1))
    (path,) = {os.path.dirname(name) for name in rows.inputFiles()}
    assert path.removeprefix("file://").startswith(folder.removeprefix("file:").replace("//", "/")) or folder in path
    assert rows.count() == 10 and rows.schema.names == ["id", "odd"]
    assert session.cut(spark.range(3)).count() == 3


def test_without_a_setting_the_warehouse_is_used(spark):
    """The setting of the session comes first; the warehouse is shared as well."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_folder(spark).startswith(f"file:{given}" if given and ":" not in given else given or "file:")


def test_empty_tables(spark):
    assert session.written(spark.range(0)).count() == 0
