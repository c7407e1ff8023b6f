"""File writers. Output stays partitioned unless a single file is asked for."""

from pyspark.sql import functions as F

from permitry.operators.vocabulary import append_types, type_to_cluster

MATCH_COLUMN = "IsMatch(Yes/No)"


def write_csv(df, path, single_file=False, mode="overwrite", quote_all=False, partition_by=(), header=True):
    """Header CSV. ``single_file`` sends all rows through one task and is for small reports only."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).options(header=header, escape='"', quoteAll=quote_all)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_metric(df, out, scope, metric, single_file=False):
    """A yearly statistic under ``out/scope/metric``, replacing what was there."""
    write_csv(df, f"{out}/{scope}/{metric}", single_file)


def write_clusters(clusters, path, single_file=False):
    """Type and cluster number without header; types may hold commas, so cells are quoted as needed."""
    write_csv(clusters.select("business", "cluster").orderBy("cluster"), path, single_file, header=False)


def write_cluster_lines(clusters, path):
    """Type and cluster number as plain ``type,cluster`` text lines."""
    clusters.select(F.concat_ws(",", "business", F.col("cluster").cast("string"))).write.mode("overwrite").text(path)


def candidate_rows(ranked, n=1000):
    """The first ``n`` ranked pairs with an empty column for the human label."""
    rows = ranked.limit(n)
    return rows.select(
        F.col("left").alias("BusinessType1"), F.col("right").alias("BusinessType2"), F.lit("").alias(MATCH_COLUMN)
    )


def write_candidates(ranked, path, n=1000):
    """Candidate pairs for labelling, one file in rank order."""
    write_csv(candidate_rows(ranked, n), path, single_file=True)


def write_type_map(vocabularies, entities, clusters, path, single_file=False):
    """Type and cluster of every type of the vocabularies, without header."""
    mapped = type_to_cluster(append_types(*vocabularies), entities, clusters)
    write_csv(mapped, path, single_file, header=False)


def write_predictions(records, path, single_file=False):
    """Published predictions as JSON records BusinessType, City, Year, Stability, a line each."""
    rows = records.select("BusinessType", "City", F.col("Year").cast("int").alias("Year"), "Stability")
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").json(path)


def write_final(df, path):
    """A final licence table with every cell quoted."""
    write_csv(df, path, quote_all=True)


def write_final_by_origin(df, path):
    """Final licences of all registers, one folder per origin, every cell quoted."""
    write_csv(df, path, quote_all=True, partition_by=("DataSetOrigin",))


def write_rows(df, path, form="parquet"):
    """Row-level tables: parquet, or header CSV."""
    if form == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(form).save(path)


def write_address_cache(cache, path, version):
    """Write a new version of the cache next to the old ones, which may still be read."""
    folder = f"{path}/version={version}"
    cache.write.mode("errorifexists").parquet(folder)
    return folder
