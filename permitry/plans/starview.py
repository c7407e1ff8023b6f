"""Licence tables seen in a star schema of orders: the binding of the operators to the test tables.

An order is a licence: its customer is the business, the market segment the type, the order priority
the subtype, the region the register. It ends with its last shipment; most open orders have no end.
"""

from pyspark.sql import functions as F


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def places(spark, folder):
    """Nation key, nation and region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select("n_nationkey", "n_name", "r_name")


STATUS_OF = {"O": "Issued", "F": "Cancelled", "P": "Pending"}


def licence_status(column):
    return F.when(column == "O", "Issued").when(column == "F", "Cancelled").otherwise("Pending")


def last_shipments(spark, folder):
    """Day of the last shipment of each order."""
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("__last"))
    return shipped.select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("__last").alias("__shipped"))


def businesses(spark, folder, region=False, nation=False):
    """Customers as businesses, keyed like the orders."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("BusinessName"),
        F.col("c_mktsegment").alias("BusinessType"), F.col("c_nationkey").alias("n_nationkey"),
    )
    if not (region or nation):
        return customer.drop("n_nationkey")
    return customer.join(places(spark, folder), "n_nationkey").withColumnRenamed("r_name", "DataSetOrigin")


def licences(spark, folder, expiry=True, region=False, statuses=None):
    """The licence table with parsed dates and years; ask only for the columns and statuses a query needs.

    Statuses are asked for by their codes, which the scan can check. Only every fourth open order has an end.
    """
    orders = table(spark, folder, "orders")
    codes = [code for code, status in STATUS_OF.items() if statuses is None or status in statuses]
    if statuses is not None:
        orders = orders.where(F.col("o_orderstatus").isin(codes))
    orders = orders.select(
        "o_orderkey", "o_custkey", licence_status(F.col("o_orderstatus")).alias("Status"),
        F.to_date("o_orderdate").alias("IssuedDate"), F.col("o_orderpriority").alias("BusinessSubType"),
    )
    rows = orders.join(businesses(spark, folder, region), "o_custkey")
    if expiry:
        ended = (F.col("Status") != "Issued") | (F.col("o_orderkey") % 4 == 0)
        rows = rows.join(last_shipments(spark, folder), "o_orderkey", "left")
        rows = rows.withColumn("ExpiryDate", F.when(ended, F.col("__shipped"))).drop("__shipped")
        rows = rows.withColumn("ExpiryYear", F.year("ExpiryDate"))
    return rows.withColumns({"IssuedYear": F.year("IssuedDate"), "YearRecorded": F.year("IssuedDate")})


def snapshots(spark, folder):
    """Orders as yearly snapshots of a register, address from the customer's nation."""
    rows = licences(spark, folder, region=True)
    number = F.col("o_orderkey").cast("string")
    latitude = F.when(F.col("Status") != "Pending", F.col("o_orderkey").cast("double"))
    return rows.withColumnRenamed("ExpiryDate", "ExpiredDate").withColumns({
        "House": number, "Street": F.col("BusinessSubType"), "City": F.col("n_name"),
        "Province": F.col("DataSetOrigin"), "Country": F.lit(None).cast("string"),
        "PostalCode": F.col("n_nationkey").cast("string"), "Latitude": latitude,
        "Longitude": -latitude, "LocalArea": F.lit(None).cast("string"),
    })


def type_vocabulary(spark, folder):
    """Part type and name as the types of one register."""
    return table(spark, folder, "part").select(F.concat_ws(" ", "p_type", "p_name").alias("BusinessType")).distinct()


def brand_vocabulary(spark, folder):
    """Part brand and name as the types of the other register."""
    return table(spark, folder, "part").select(F.concat_ws(" ", "p_brand", "p_name").alias("BusinessType")).distinct()


def part_labels(spark, folder):
    """Parts as labelled rows in key order: brand and name, type and name, size."""
    return table(spark, folder, "part").select(
        F.concat_ws(" ", "p_type", "p_name").alias("type"), F.concat_ws(" ", "p_brand", "p_name").alias("brand"),
        F.col("p_name").alias("name"), "p_size", F.col("p_partkey").alias("ordinal"),
        F.when(F.col("p_size") > 25, "Yes").otherwise("No").alias("label"),
    )


def word_vectors(spark, folder, words):
    """Vectors for words: each word takes the embedding its MD5 sum points to."""
    vectors = table(spark, folder, "embeddings")
    count = vectors.agg(F.count(F.lit(1)))
    place = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint") % count.scalar()
    placed = words.select("word").distinct().select("word", place.alias("vec_id"))
    return placed.join(vectors.select("vec_id", F.col("embedding").alias("vec")), "vec_id").select("word", "vec")

