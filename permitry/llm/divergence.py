"""Source divergence audit: how far the term shares of each source are from those of other sources and of their language.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case. Each language keeps the V terms that at least
``FEWEST`` of its documents hold. Every group (language, source), and each language, gives a kept term with c occurrences
the share p = 1 + floor(SCALE (c + 2) / (N + 2 V)), N the sum of c; f = floor((p - q)^2 / (p + q)) compares two shares.

1. Tasks count the terms of each slice of texts in numpy (``packed_terms``); Spark adds the counts, pre-aggregated in each
   task, by group and term, then by language and term. A group's counts are never in one task.
2. ``pair``: f summed over all kept terms, for each two sources of a language. A term that a source lacks has there the
   share of c = 0, so only terms present in a source are looked at: their f against the other's share of nothing, from the
   source's numbers of terms by count, and a correction for terms that both hold, from a join by term. All else is
   a multiple of f of the two shares of nothing.
3. ``term``: kept terms of a group with p above the language's q, the first ``TOP`` by f; Spark limits each task's rows
   before it ranks them.

All arithmetic is exact: products are decimals, f of two shares fits a long.

Defined cases: NULL text, language and source count as empty; a group without kept terms has c = 0 for all; without kept
terms in the language (V = 0) pairs have value 0; equal values rank by item in the order of UTF-8; each row is a document,
also a repeated one; an empty table gives an empty result; columns other than the three named ones are not looked at.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from permitry.llm import packed_terms
from permitry.llm.slices import gathered, slices
from permitry.session import written

FEWEST = 10
TOP = 10
SCALE = 1_000_000_000
#: Texts counted at once: the more, the fewer counts of one term go to Spark.
SLICE_BYTES = 16 << 20
#: Counts sent to Spark at once.
ROWS = 1 << 16
_COUNTS = "lang string, source string, term string, n bigint, documents bigint"


def _counted(batches):
    """Counts of the terms of each slice; a row without term stands for each group that occurs."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("documents", pa.int64())])
    for whole in gathered(batches, 2, SLICE_BYTES):
        for batch in slices(whole, 2, SLICE_BYTES):
            names = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
            pairs = [(n["lang"], n["source"]) for n in names.to_pylist()]
            own = sorted(set(pairs))
            place = {pair: i for i, pair in enumerate(own)}
            group = np.array([place[pair] for pair in pairs], np.int64)
            order = np.argsort(group, kind="stable")
            texts = batch.column(2).cast(pa.binary()).take(pa.array(order)).to_pylist()
            ends = np.cumsum([len(t) + 1 for t in texts])
            joined = b"\0".join([*texts, b""])
            # the counting has its own copy: neither the texts nor their bytes are held beside it
            counted = packed_terms.counted(np.frombuffer(joined, np.uint8), ends, group[order])
            del texts, joined
            langs, sources = (pa.array([pair[i] for pair in own], pa.string()) for i in (0, 1))

            def rows(groups, terms, n, documents):
                at = pa.array(groups)
                return pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), terms, pa.array(n), pa.array(documents)], schema=schema)

            none = np.zeros(len(own), np.int64)
            yield rows(np.arange(len(own)), pa.nulls(len(own), pa.string()), none, none)
            for lengths, joined, at, n, documents in counted:
                places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                terms = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(places), pa.py_buffer(joined))
                for first in range(0, len(at), ROWS):
                    part = slice(first, first + ROWS)
                    yield rows(at[part], terms[part], n[part], documents[part])


def term_counts(docs, text_column="text", lang_column="lang", source_column="source"):
    """Rows (lang, source, term, n, documents); each group that occurs has a row with NULL term."""
    named = {"lang": lang_column, "source": source_column, "text": text_column}
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    found = rows.mapInArrow(_counted, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _whole(column):
    return F.col(column).cast("decimal(38,0)")


def _share(n, total, kept):
    """1 + floor(SCALE (n + 2) / (total + 2 kept)), exact."""
    wide = "decimal(20,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (n.cast(wide) + F.lit(2).cast(wide)).cast(wide)
    below = (total.cast(wide) + F.lit(2).cast("decimal(1,0)") * kept.cast("decimal(18,0)")).cast(wide)
    return F.lit(1).cast("bigint") + F.call_function("div", above, below)


def distance(p, q):
    """floor((p - q)^2 / (p + q)) of two positive longs of up to 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts, fewest=FEWEST):
    """From written counts: terms (lang, term, source, p, q, n) and groups (lang, source, kept, p_none)."""
    terms = counts.where("term is not null")
    wide = F.sum("documents") >= fewest
    by_term = terms.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), wide.alias("keep"))
    kept = written(by_term.where("keep").drop("keep"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("lang_total"))
    each = written(terms.drop("documents").join(kept, ["lang", "term"]))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = counts.where("term is null").select("lang", "source")
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    nothing = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept")))
    groups = written(groups.withColumn("p_none", nothing))
    found = each.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "n", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("all_n"), F.col("lang_total"), F.col("kept")).alias("q"), "p_none")
    return written(found), groups


def _ranked(rows):
    ordered = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(ordered))


def top_terms(terms, top=TOP):
    """The terms with the largest distance of each group among those with a share above the language's."""
    above = terms.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        distance(F.col("p"), F.col("q")).alias("value"))
    return _ranked(above).where(F.col("rank") <= top)


def _two(left, right, keys, order="<"):
    """Rows of two tables with the columns ``source`` and others, joined on keys, for sources in this order."""
    a = left.select(*[F.col(c) if c in keys else F.col(c).alias(f"a_{c}") for c in left.columns])
    b = right.select(*[F.col(c) if c in keys else F.col(c).alias(f"b_{c}") for c in right.columns])
    return a.join(b, keys).where(f"a_source {order} b_source")


def pair_distances(terms, groups):
    """Rows (lang, source, item, value) for each two sources of a language; each pair is computed once."""
    alone, none = groups.select("lang", "source", "p_none", "kept"), F.lit(0).cast("bigint")
    by_share = terms.groupBy("lang", "source", "p_none", "p").agg(F.count("*").alias("n"))
    a_p, b_p, a_none, b_none = (F.col(c) for c in ("a_p", "b_p", "a_p_none", "b_p_none"))
    first, second = F.least("a_source", "b_source").alias("first"), F.greatest("a_source", "b_source").alias("second")
    base = _two(alone, alone, ["lang"]).select(
        "lang", first, second, F.coalesce(F.col("a_kept") * distance(a_none, b_none), none).alias("value"))
    # what a source's own terms add, against the other's share of nothing
    added = _two(by_share, alone.drop("kept"), ["lang"], "<>").select(
        "lang", first, second, (F.col("a_n") * (distance(a_p, b_none) - distance(a_none, b_none))).alias("value"))
    compared = terms.select("lang", "term", "source", "p", "p_none")
    both = _two(compared, compared, ["lang", "term"]).select(
        "lang", first, second,
        (distance(a_p, b_p) - distance(a_p, b_none) - distance(a_none, b_p) + distance(a_none, b_none)).alias("value"))
    parts = [rows.groupBy("lang", "first", "second").agg(F.sum("value").alias("value")) for rows in (base, added, both)]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))
    directions = F.array(F.struct(F.col("first").alias("source"), F.col("second").alias("item")),
                         F.struct(F.col("second").alias("source"), F.col("first").alias("item")))
    return found.select("lang", "value", F.inline(directions)).select("lang", "source", "item", "value")


def audit(docs, text_column="text", lang_column="lang", source_column="source", fewest=FEWEST, top=TOP):
    """Rows (lang, source, part, item, value, rank): all pairs of a language's sources, and each group's first terms."""
    terms, groups = shares(written(term_counts(docs, text_column, lang_column, source_column)), fewest)
    pairs = pair_distances(terms, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return _ranked(pairs).unionByName(top_terms(terms, top))
