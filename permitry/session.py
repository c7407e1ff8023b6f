"""Session settings the operators are written for, and tables kept in the folder that all executors share."""

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows reach Python workers in batches of this size, whatever the length of a text
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def ship():
    """Send functions of this package to the workers by value: nothing has to be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


def tune(spark):
    """Apply the runtime SQL settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores="*", partitions=8, memory="8g", app="permitry", **extra):
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _delete_at_end(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def shared_folder(spark):
    """The folder for intermediate tables, always one that all executors share.

    It is the one of ``spark.checkpoint.dir``. A session without that setting uses the warehouse, which is
    shared by definition; its part is deleted when the application ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate/{context.applicationId}"
            _delete_at_end(spark, folder)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch(spark, kind):
    """Address of a new folder in the shared folder, deleted when the application ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _delete_at_end(spark, folder)
    return folder


def written(df):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Unlike a checkpoint it is computed once, compressed, and read by column. The table is deleted when the
    application ends.
    """
    spark = df.sparkSession
    folder = scratch(spark, "table")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Cut the lineage of a table that several steps read.
cut = written
