"""A many-to-many join that stays balanced when keys repeat on both sides.

Joins to tables with one row per key need nothing of the kind: Spark's skew join splits their hot
partitions at run time (``session.SETTINGS``).
"""

from pyspark.sql import functions as F

from permitry.session import cut

CELL = 2_000
SALTS = 32


def key_parts(left, right, left_key, right_key, cell=CELL):
    """Rows (key, rows, columns) of the keys that need more than one cell, from counts of all keys of both sides."""
    def counted(df, key, name):
        return df.groupBy(F.col(key).alias("__key")).agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias(name))

    both = counted(left, left_key, "__rows").join(counted(right, right_key, "__columns"), "__key")
    return both.where((F.col("__rows") > 1) | (F.col("__columns") > 1))


def grid_join(left, right, left_key, right_key, condition, cell=CELL):
    """Inner join where both sides may repeat a key many times; the sides share no column name.

    A key with more than ``cell`` rows on a side is cut into a grid of cells of about ``cell`` rows a
    side: each left row goes to one grid row, each right row to one grid column, so every pair meets in
    exactly one cell. Rows learn their grid from a table of key counts, which is written once; a hot key's
    rows are salted for that, so no exchange goes by the key alone. ``condition`` is checked inside the join.
    """
    table = cut(key_parts(left, right, left_key, right_key, cell))
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if table.isEmpty():
        # no key is hot; as below, the partitions are not to be put together by their size
        a, b = left.repartition(partitions, left_key), right.repartition(partitions, right_key)
        return a.join(b, (F.col(left_key) == F.col(right_key)) & condition)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def placed(df, key, own, own_parts, other, other_parts):
        salt = F.pmod(F.xxhash64(*df.columns, F.lit(1)), F.lit(SALTS)).cast("int")
        rows = df.withColumn("__salt", salt)
        sized = rows.join(salted, (rows[key] == salted["__key"]) & (rows["__salt"] == salted["__salt"]), "left")
        own_cell = F.pmod(F.xxhash64(*df.columns), F.coalesce(own_parts, F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce(other_parts, F.lit(1)) - 1)
        cells = sized.select(*df.columns, own_cell.alias(own), F.explode(every).alias(other))
        # the join makes more rows than it reads, so its partitions are not to be put together by their size
        return cells.repartition(partitions, key, *sorted((own, other), key=lambda c: c[:5]))

    rows, columns = F.col("__rows"), F.col("__columns")
    a = placed(left, left_key, "__row_l", rows, "__column_l", columns)
    b = placed(right, right_key, "__column_r", columns, "__row_r", rows)
    same_cell = (F.col("__row_l") == F.col("__row_r")) & (F.col("__column_l") == F.col("__column_r"))
    pairs = a.join(b, (F.col(left_key) == F.col(right_key)) & same_cell & condition)
    return pairs.drop("__row_l", "__column_l", "__row_r", "__column_r")
