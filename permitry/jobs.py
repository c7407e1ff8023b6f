"""The jobs from files to files, for ``spark-submit`` or ``python -m permitry.jobs``.

    ingest         zip archives or CSV files of yearly snapshots  ->  snapshots
    clean          snapshots or a register, and an address cache  ->  final licences, next version of the cache
    pending        the address cache                              ->  the next addresses to ask a geocoder for
    geocoded       the address cache, geocoder replies            ->  next version of the cache
    candidates     final licences of both registers               ->  pairs to label
    clusters       final licences, labelled pairs                 ->  types with cluster numbers to name
    map-types      final licences, labelled pairs, named clusters ->  type map
    finish         final licences, type map                       ->  licences with mapped types, unmapped rows
    trends         licences                                       ->  yearly statistics, predictions

With ``--steps folder`` the long jobs keep their intermediate tables there, and a job that was stopped and is started
again with the same inputs and parameters goes on behind its last finished step.
"""

import argparse

from pyspark.sql import SparkSession

from permitry import session
from permitry.functions.geo import reply_coordinates
from permitry.operators.address import apply_geocodes, pending_addresses
from permitry.operators.clean import clean_licences
from permitry.operators.vocabulary import business_types, cluster_map, entity_map
from permitry.plans import clean_registers, harmonise, trends
from permitry.plans.ingest import ingest
from permitry.schemas import ADDRESS_KEYS, LICENCE, address_cache
from permitry.sinks import writers
from permitry.sources import readers
from permitry.steps import Steps, fresh


def _step(spark, o, *inputs, **parameters):
    """How a job keeps its steps: below the given folder, or only as long as it runs."""
    return Steps(spark, o.steps, inputs, job=o.job, **parameters) if o.steps else fresh


def run_ingest(spark, o):
    snapshots = ingest(spark, o.input, o.default_year, zipped=o.zipped, whole_archives=o.whole_archives)
    writers.write_csv(snapshots, o.out)


def run_clean(spark, o):
    version = readers.newest_version(spark, o.cache)
    cache = spark.createDataFrame([], address_cache()) if version is None else readers.read_address_cache(spark, o.cache)
    step = _step(spark, o, o.input, register=o.register)
    if o.register:
        licences, cache = clean_registers.clean_register(readers.read_register(spark, o.input), cache, step=step)
    else:
        licences, cache = clean_registers.clean_snapshots(readers.read_snapshots(spark, o.input), cache, step=step)
    writers.write_final(licences, o.out)
    writers.write_address_cache(cache, o.cache, (o.cache_version or version or 0) + 1)


def run_pending(spark, o):
    asked = pending_addresses(readers.read_address_cache(spark, o.cache), o.n)
    asked.write.mode("overwrite").json(o.out)


def run_geocoded(spark, o):
    cache, version = readers.read_address_cache(spark, o.cache), readers.newest_version(spark, o.cache)
    replies = readers.read_replies(spark, o.replies)
    found = replies.select(*ADDRESS_KEYS, reply_coordinates("reply").alias("at")).select(*ADDRESS_KEYS, "at.*")
    writers.write_address_cache(apply_geocodes(cache, found), o.out, version + 1)


def _finals(spark, o):
    return (readers.read_csv(spark, path, LICENCE) for path in (o.a, o.b))


def run_candidates(spark, o):
    vectors = readers.read_word_vectors(spark, o.vectors) if o.vectors else None
    step = _step(spark, o, *(path for path in (o.a, o.b, o.vectors) if path), n=o.n, exact=o.exact)
    writers.write_csv(harmonise.candidates(*_finals(spark, o), o.n, vectors, o.exact, step), o.out, single_file=True)


def run_clusters(spark, o):
    labels, step = readers.read_entity_labels(spark, o.labels), _step(spark, o, o.a, o.b, o.labels, k=o.k)
    named = harmonise.clusters_to_name(*_finals(spark, o), labels, o.k, step)
    writers.write_clusters(named, o.out)


def run_map_types(spark, o):
    a, b = _finals(spark, o)
    entities = entity_map(readers.read_entity_labels(spark, o.labels))
    clusters = cluster_map(readers.read_cluster_labels(spark, o.clusters))
    writers.write_type_map([business_types(a), business_types(b)], entities, clusters, o.out)


def run_finish(spark, o):
    mapping, step = readers.read_type_map(spark, o.map), _step(spark, o, o.a, o.b, o.map)
    merged, unmapped = harmonise.finish(*_finals(spark, o), mapping, step)
    writers.write_final_by_origin(merged, f"{o.out}/licences")
    writers.write_final(unmapped, f"{o.out}/unmapped")


def run_trends(spark, o):
    licences = _step(spark, o, o.input)("licences", lambda: clean_licences(readers.read_csv(spark, o.input)))
    trends.write_statistics(licences, f"{o.out}/statistics")
    # an unmapped type is the empty text, which CSV reads as NULL: it cannot be a category of the regression
    _, _, published = trends.forecast(licences.where("BusinessType <> ''"))
    writers.write_predictions(published, f"{o.out}/predictions")


def _parser():
    parser = argparse.ArgumentParser(prog="permitry", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, *required, **optional):
        one = jobs.add_parser(name)
        one.set_defaults(run=run)
        for argument in (*required, "out"):
            one.add_argument(f"--{argument}", required=True)
        for argument, (kind, default) in optional.items():
            flag = f"--{argument.replace('_', '-')}"
            one.add_argument(flag, action="store_true") if kind is bool else one.add_argument(flag, type=kind, default=default)

    kept = {"steps": (str, None)}
    job("ingest", run_ingest, "input", default_year=(int, 2017), zipped=(bool, False), whole_archives=(bool, False))
    job("clean", run_clean, "input", "cache", register=(bool, False), cache_version=(int, 0), **kept)
    job("pending", run_pending, "cache", n=(int, 1000))
    job("geocoded", run_geocoded, "cache", "replies")
    job("candidates", run_candidates, "a", "b", n=(int, 1000), vectors=(str, None), exact=(bool, False), **kept)
    job("clusters", run_clusters, "a", "b", "labels", k=(int, 30), **kept)
    job("map-types", run_map_types, "a", "b", "labels", "clusters")
    job("finish", run_finish, "a", "b", "map", **kept)
    job("trends", run_trends, "input", **kept)
    return parser


def main(arguments=None):
    options = _parser().parse_args(arguments)
    options.run(session.tune(SparkSession.builder.appName(f"permitry {options.job}").getOrCreate()), options)


if __name__ == "__main__":
    main()
