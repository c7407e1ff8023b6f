"""Reconcile the business types of two registers. People label between the steps."""

from permitry.operators.cluster import CLUSTERS, cluster_types
from permitry.operators.project import merge_licences
from permitry.operators.similarity import jaccard_top, mover_top, relaxed_top
from permitry.operators.vocabulary import (
    append_types, business_types, cluster_map, entity_map, merged_vocabulary, replaced_and_unmapped, type_map,
    type_to_cluster,
)
from permitry.sinks.writers import candidate_rows
from permitry.steps import fresh


def candidates(licences_a, licences_b, n=1000, vectors=None, exact=False, step=fresh):
    """Step 1: the best pairs to label, register B first, by words or, with vectors, by distance, relaxed or exact.

    ``step`` keeps the tables on the way (``steps.Steps``); here and below each is made once.
    """
    types_a = step("types_a", lambda: business_types(licences_a))
    types_b = step("types_b", lambda: business_types(licences_b))
    if vectors is None:
        return candidate_rows(step("ranked", lambda: jaccard_top(types_b, types_a, n)), n)
    top = mover_top if exact else relaxed_top
    return candidate_rows(step("ranked", lambda: top(types_b, types_a, vectors, n)), n)


def clusters_to_name(licences_a, licences_b, entity_labels, k=CLUSTERS, step=fresh, **clustering):
    """Step 3: types of both registers, matched ones merged, with cluster numbers to be named."""
    merged = step("merged", lambda: merged_vocabulary(
        business_types(licences_a), business_types(licences_b), entity_map(entity_labels)
    ))
    return step("clustered", lambda: cluster_types(merged, k, **clustering))


def map_types(licences_a, licences_b, entity_labels, cluster_labels):
    """Step 5: every type with its cluster name, the empty text where there is none."""
    types = append_types(business_types(licences_a), business_types(licences_b))
    return type_to_cluster(types, entity_map(entity_labels), cluster_map(cluster_labels))


def finish(licences_a, licences_b, map_rows, step=fresh):
    """Step 7: all licences with cluster names as types, and the rows whose type has no entry.

    Both come from one plain join with the map, which Spark broadcasts when it is small.
    """
    merged = merge_licences(licences_a, licences_b)
    return replaced_and_unmapped(merged, type_map(map_rows), keep=lambda df: step("mapped", lambda: df))
