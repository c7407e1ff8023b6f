"""Similar business types: token Jaccard and word-mover distance, relaxed or exact, between two vocabularies.

Neither compares all pairs. Both reduce a vocabulary to *bags*, one row per distinct set (or multiset)
of words, give every bag a list of keys such that two bags can only be close when they share a key, and
join on the keys. A pair sharing several keys is kept only at the first shared one, so no second
shuffle is needed to remove repeats.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitry.functions.text import tokens
from permitry.functions.vectors import euclidean
from permitry.operators.near import near_words
from permitry.operators.skew import CELL, grid_join
from permitry.operators.transport import mover_distance
from permitry.schemas import STOP_WORDS
from permitry.session import cut

SMALL = 1e-9
PARTS = 256


def _bags(types, column, stop_words, distinct, members=None):
    """Words of each type as a sorted bag, written out; with ``members``, one row per bag and its first names.

    The names kept are the ``members`` smallest ones: a ranking of that length by score and names can
    hold no others of the same bag.
    """
    words = tokens("name", stop_words)
    bag = F.array_sort(F.array_distinct(words) if distinct else words)
    named = types.select(F.col(column).alias("name")).where(F.col("name").isNotNull()).distinct()
    rows = named.select(bag.alias("bag"), "name")
    if members is None:
        return cut(rows)
    rows = _smallest(rows.withColumn("__part", F.pmod(F.xxhash64("name"), F.lit(PARTS))), ["bag", "__part"], members)
    kept = _smallest(rows, ["bag"], members)
    return cut(kept.groupBy("bag").agg(F.array_sort(F.collect_list("name")).alias("name")))


def _smallest(rows, by, n):
    """The ``n`` smallest names of each group."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy("name")))
    return ranked.where(F.col("__rank") <= n).select("bag", "name")


def _side(df, suffix):
    return df.select(*[F.col(c).alias(f"{c}_{suffix}") for c in df.columns])


def _join_on_keys(left, right, condition, cell):
    """Pairs of rows that share an element of their ordered ``keys``, once each.

    ``probe`` holds the keys a row is sent to, each followed by the ``kind`` of the left and of the right
    row it is meant for. The first shared element of two rows must be probed by both.
    """
    a = _side(left, "l").withColumn("key_l", F.explode("probe_l"))
    b = _side(right, "r").withColumn("key_r", F.explode("probe_r"))
    first_shared = F.element_at(F.array_intersect("keys_l", "keys_r"), 1)
    once = F.col("key_l") == _key(first_shared, F.col("kind_l"), F.col("kind_r"))
    return grid_join(a, b, "key_l", "key_r", condition & once, cell)


def _key(word, left_kind, right_kind):
    return F.concat_ws(":", word, left_kind, right_kind)


def _probe_all(df, words="keys"):
    """All rows of one kind, sent to all their words."""
    anyone = F.lit(0)
    return df.withColumn("kind", anyone).withColumn("probe", F.transform(words, lambda w: _key(w, anyone, anyone)))


def _by_rarity(left, right):
    """Both sides with ``keys``: the words of the bag, rare ones (over both sides) first."""
    def words(df):
        return df.select("bag", F.explode("bag").alias("word"))

    seen = words(left).unionByName(words(right)).groupBy("word").agg(F.count(F.lit(1)).alias("seen"))

    def ordered(df):
        counted = words(df.select("bag").distinct()).join(seen, "word")
        ranked = F.array_sort(F.collect_list(F.struct("seen", "word")))
        keys = counted.groupBy("bag").agg(F.transform(ranked, lambda x: x["word"]).alias("keys"))
        return df.join(keys, "bag")

    return ordered(left), ordered(right)


EXACT_SIZES, STEP = 8, 1.25


def _size_class(size):
    """Class of a bag size: single sizes up to eight, then steps of a quarter."""
    steps = F.floor(F.log(size / F.lit(float(EXACT_SIZES))) / math.log(STEP))
    return F.when(size <= EXACT_SIZES, size).otherwise(EXACT_SIZES + steps).cast("int")


def _least_size(size_class):
    """No size of the class is smaller."""
    least = F.floor(EXACT_SIZES * F.pow(F.lit(STEP), size_class - EXACT_SIZES) * (1 - SMALL))
    return F.when(size_class <= EXACT_SIZES, size_class).otherwise(least)


def _probe_prefixes(df, at_least, is_left):
    """Rows with their size class, sent to the first words that a partner of some size class must share.

    Bags of sizes ``a`` and ``b`` that reach the threshold ``t`` share at least ``t / (1 + t) * (a + b)``
    words, so the first shared word lies among the first ``a`` minus that number plus one.
    """
    size, own = F.size("keys"), _size_class(F.size("keys"))
    smallest = F.greatest(F.lit(1), F.ceil(size * at_least - SMALL).cast("int"))
    partners = F.sequence(_size_class(smallest), _size_class(F.floor(size / F.lit(at_least) + SMALL).cast("int")))

    def prefix(other):
        shared = F.greatest(size * at_least, (size + _least_size(other)) * (at_least / (1 + at_least)))
        length = F.greatest(F.lit(0), F.least(size, size + 1 - F.ceil(shared - SMALL).cast("int")))
        kinds = (own, other) if is_left else (other, own)
        return F.transform(F.slice("keys", F.lit(1), length), lambda word: _key(word, *kinds))

    return df.withColumn("kind", own).withColumn("probe", F.flatten(F.transform(partners, prefix)))


def _jaccard_join(left, right, at_least, cell):
    """Bag pairs with a Jaccard similarity of at least ``at_least`` (above zero when that is 0).

    With a threshold the bags are sent only to their rarest words, so frequent words are seldom joined on.
    """
    size_l, size_r = F.size("keys_l"), F.size("keys_r")
    shared = F.size(F.array_intersect("keys_l", "keys_r"))
    score = shared / (size_l + size_r - shared)
    if at_least == 0:
        pairs = _join_on_keys(_probe_all(left), _probe_all(right), F.lit(True), cell)
    else:
        a, b = _probe_prefixes(left, at_least, True), _probe_prefixes(right, at_least, False)
        pairs = _join_on_keys(a, b, score >= at_least - SMALL, cell)
    return pairs.withColumn("score", score)


def jaccard_pairs(left, right, at_least, left_column="BusinessType", right_column="BusinessType",
                  stop_words=STOP_WORDS, cell=CELL):
    """All pairs of types with a Jaccard similarity of their word sets of ``at_least``, which is above zero."""
    if at_least <= 0:
        raise ValueError("at_least must be above zero: without a threshold the result is every pair with a common word")
    a, b = _by_rarity(
        _bags(left, left_column, stop_words, True), _bags(right, right_column, stop_words, True)
    )
    a, b = cut(a), cut(b)
    pairs = _jaccard_join(a, b, at_least, cell)
    return pairs.select(F.col("name_l").alias("left"), F.col("name_r").alias("right"), "score")


def _best_names(bag_pairs, n, ascending):
    """The best ``n`` name pairs out of scored bag pairs, ties by name.

    Each bag pair is represented by its smallest names, so the best ``n`` bag pairs hold the best ``n``
    name pairs; of one bag pair the first ``n`` in name order are spread out.
    """
    score = F.col("score") if ascending else F.desc("score")
    lead = [F.element_at("name_l", 1), F.element_at("name_r", 1)]
    best = bag_pairs.orderBy(score, *lead).limit(n)
    needed = F.ceil(F.lit(n) / F.size("name_r")).cast("int")
    names = best.select(F.explode(F.slice("name_l", F.lit(1), needed)).alias("left"), "name_r", "score")
    spread = names.select("left", F.explode("name_r").alias("right"), "score")
    return spread.orderBy(score, "left", "right").limit(n)


def _sent(df, seen, until, floor, is_left):
    """Rows with ``probe``: up to ``until`` of their words, so marked that two meet unless both are among the first ``seen``.

    A pair whose first common word has ``p`` words before it in a bag of size ``s`` scores ``1 - p / s`` at most, so
    only words whose best possible score reaches ``floor`` are sent.
    """
    reachable = F.floor(F.size("keys") * F.lit(1 - floor + SMALL)).cast("int") + 1
    words = F.slice("keys", F.lit(1), F.least(F.lit(until), reachable))
    old, new = F.slice(words, F.lit(1), F.lit(seen)), F.slice(words, F.lit(seen + 1), F.lit(until))

    def marked(words, mark):
        return F.transform(words, lambda word: F.concat(F.lit(mark), word))

    # a new word of the left meets all of the right, an old one of the left only new ones
    marks = [marked(new, "n"), marked(old, "o")] if is_left else [marked(words, "n"), marked(new, "o")]
    return df.withColumn("probe", F.concat(*marks))


def _round(left, right, seen, until, floor, cell):
    """Bag pairs whose first common word is among the first ``until`` words of both, but not the first ``seen`` of both."""
    a = _side(_sent(left, seen, until, floor, True), "l").withColumn("key_l", F.explode("probe_l"))
    b = _side(_sent(right, seen, until, floor, False), "r").withColumn("key_r", F.explode("probe_r"))
    common = F.array_intersect("keys_l", "keys_r")
    score = F.size(common) / (F.size("keys_l") + F.size("keys_r") - F.size(common))
    once = F.element_at(common, 1) == F.substr("key_l", F.lit(2))
    return grid_join(a, b, "key_l", "key_r", once & (score >= floor - SMALL), cell).select("name_l", "name_r", score.alias("score"))


def _last_score(best, n):
    """The ``n``-th best score of the names of at most ``n`` ranked bag pairs, 0 if they have fewer."""
    held = 0
    for row in best.select("score", F.size("name_l").alias("l"), F.size("name_r").alias("r")).orderBy(F.desc("score")).collect():
        held += row["l"] * row["r"]
        if held >= n:
            return row["score"]
    return 0.0


def jaccard_top(left, right, n=1000, left_column="BusinessType", right_column="BusinessType",
                stop_words=STOP_WORDS, cell=CELL):
    """The ``n`` most similar pairs of types, ties by name.

    Words of a bag are in order of rarity. The first round looks at two words of each bag, every other at one more, later
    at half as many more as so far. After each, a pair not seen yet scores no more than its bags' unseen words allow; bags that cannot reach the
    ``n``-th best score any more send no words, and when there are no others the ranking is complete. Frequent words
    are joined on only if the best ``n`` pairs hang on them.
    """
    a, b = _by_rarity(
        _bags(left, left_column, stop_words, True, n), _bags(right, right_column, stop_words, True, n)
    )
    a, b = cut(a), cut(b)
    longest = a.select("keys").unionByName(b.select("keys")).agg(F.max(F.size("keys"))).first()[0] or 0
    seen, floor, best = 0, 0.0, None
    lead = [F.desc("score"), F.element_at("name_l", 1), F.element_at("name_r", 1)]
    while True:
        until = max(2, seen + 1, seen * 3 // 2)
        found = _round(a, b, seen, until, floor, cell)
        best = cut((found if best is None else best.unionByName(found)).orderBy(*lead).limit(n))
        floor, seen = _last_score(best, n), until
        # the longest bag has the best possible score left
        if seen >= longest or 1 - seen / longest < floor - SMALL:
            return _best_names(best, n, ascending=False)


def _lexicon(left, right, vectors):
    """Known words of the bags: in how many left and right bags they occur, vector, distance to a pivot.

    The pivot is one fixed word; any choice is exact.
    """
    def words(df, side):
        return df.select("bag").distinct().select(F.explode(F.array_distinct("bag")).alias("word"), F.lit(side).alias("side"))

    seen = words(left, 0).unionByName(words(right, 1)).groupBy("word").agg(
        F.sum(1 - F.col("side")).alias("in_left"), F.sum("side").alias("in_right")
    )
    known = cut(vectors.select("word", F.col("vec").cast("array<float>").alias("vec")).join(seen, "word"))
    pivot = known.orderBy(F.xxhash64("word"), "word").select("vec").first()
    return None if pivot is None else known.withColumn("at", euclidean("vec", F.lit(pivot["vec"]).cast("array<double>")))


def _weighted(bags, lexicon):
    """Bags with a number and their known words, rare ones first, each with its share and vector.

    Bags without any known word drop out.
    """
    words = bags.select("bag").distinct().select("bag", F.explode("bag").alias("word"))
    counts = words.groupBy("bag", "word").agg(F.count(F.lit(1)).alias("times"))
    entry = lexicon.select("word", (F.col("in_left") + F.col("in_right")).alias("seen"), "vec")
    parts = counts.join(entry, "word").groupBy("bag").agg(
        F.sum("times").alias("total"), F.array_sort(F.collect_list(F.struct("seen", "word", "times", "vec"))).alias("parts")
    )
    flat = parts.select(
        F.col("bag"),
        F.transform("parts", lambda p: p["word"]).alias("words"),
        F.transform("parts", lambda p: p["times"] / F.col("total")).alias("weights"),
        F.transform("parts", lambda p: p["vec"]).alias("vectors"),
    )
    return cut(bags.join(flat, "bag").drop("bag").withColumn("id", F.monotonically_increasing_id()))


def relaxed_distances(weights_a, vectors_a, weights_b, vectors_b):
    """Relaxed word-mover distances of pairs of bags given as lists of weights and of vectors.

    Each word travels to the nearest word of the other bag; the larger of both directions, a lower bound
    of the word-mover distance. Pairs of equal bag sizes are computed together.
    """
    shapes = pd.Series([(len(a), len(b)) for a, b in zip(weights_a, weights_b)])
    out = np.empty(len(shapes))
    for where in shapes.groupby(shapes).indices.values():
        a, b = (np.array([np.stack(v[i]) for i in where], dtype=float) for v in (vectors_a, vectors_b))
        wa, wb = (np.array([w[i] for i in where]) for w in (weights_a, weights_b))
        cost = np.empty((len(where), a.shape[1], b.shape[1]))
        for j in range(b.shape[1]):
            cost[:, :, j] = np.sqrt(((a - b[:, j : j + 1, :]) ** 2).sum(axis=2))
        out[where] = np.maximum((wa * cost.min(axis=2)).sum(axis=1), (wb * cost.min(axis=1)).sum(axis=1))
    return out


@F.pandas_udf(T.DoubleType())
def _relaxed(wa: pd.Series, va: pd.Series, wb: pd.Series, vb: pd.Series) -> pd.Series:
    return pd.Series(relaxed_distances(wa.array, va.array, wb.array, vb.array))


# marked so that the filter on the distance does not compute it a second time
_relaxed = _relaxed.asNondeterministic()


@F.pandas_udf(T.DoubleType())
def _exact(wa: pd.Series, va: pd.Series, wb: pd.Series, vb: pd.Series) -> pd.Series:
    return pd.Series([mover_distance(*pair) for pair in zip(wa, va, wb, vb)], dtype=float)


_exact = _exact.asNondeterministic()


def _reach(within, typical):
    """How far to look for near words: up to four radii, but no further than half of a typical distance."""
    return max(within, SMALL, min(4 * within, typical / 2))


def _scored(pairs, left, right, measure=_relaxed):
    """Pairs (id_l, id_r) with names and distance; words and vectors are attached once, here."""
    both = pairs.join(_side(left, "l"), "id_l").join(_side(right, "r"), "id_r")
    score = measure("weights_l", "vectors_l", "weights_r", "vectors_r").alias("score")
    return both.select("id_l", "id_r", "name_l", "name_r", score)


def _relaxed_join(left, right, lexicon, within, typical, cell):
    """Bag pairs with a relaxed distance of at most ``within``.

    Words of the left bag that are not within ``reach`` of the right bag travel further than that, so
    their share is at most ``within / reach``. A bag is therefore sent only to its first words whose
    share exceeds that bound, rare words first. The join carries numbers and words only.
    """
    reach = _reach(within, typical)
    allowed = within / reach + SMALL

    running = F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.aggregate(
        F.slice("weights", F.lit(1), i), F.lit(0.0), lambda total, w: total + w))
    enough = F.size(F.filter(running, lambda share: share <= allowed)) + 1
    a = left.select(F.col("id").alias("id_l"), F.explode(F.slice("words", F.lit(1), enough)).alias("key_l"))
    words = right.select(F.col("id").alias("id_r"), F.explode("words").alias("word"))
    b = words.join(near_words(lexicon, reach), "word").select("id_r", F.col("near").alias("key_r")).distinct()
    pairs = grid_join(a, cut(b), "key_l", "key_r", F.lit(True), cell).select("id_l", "id_r").distinct()
    return _scored(pairs, left, right).where(F.col("score") <= within)


def _distances(lexicon):
    """A bound of all distances between the words, and a typical one."""
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x))
    found = lexicon.agg(F.max(length), F.percentile_approx("at", 0.5)).first()
    return 2 * found[0] + SMALL, found[1]


def _nothing(spark):
    return spark.createDataFrame([], "left string, right string, distance double")


def relaxed_pairs(left, right, vectors, within, left_column="BusinessType", right_column="BusinessType",
                  stop_words=STOP_WORDS, cell=CELL):
    """All pairs of types with a relaxed word-mover distance of at most ``within``.

    Types without any known word have no distance and are left out.
    """
    a, b = _bags(left, left_column, stop_words, False), _bags(right, right_column, stop_words, False)
    lexicon = _lexicon(a, b, vectors)
    if lexicon is None:
        return _nothing(left.sparkSession)
    _, typical = _distances(lexicon)
    pairs = _relaxed_join(_weighted(a, lexicon), _weighted(b, lexicon), lexicon, within, typical, cell)
    return pairs.select(F.col("name_l").alias("left"), F.col("name_r").alias("right"), F.col("score").alias("distance"))


def _first_radius(left, right, n, widest, cell, measure=_relaxed):
    """The largest distance among the pairs most alike by their words, and how many pairs that are."""
    a, b = (df.select("id", "name", F.col("words").alias("keys")) for df in (left, right))
    radius, held = widest / 32, 0
    for at_least in (0.5, 0.25):
        pairs = _jaccard_join(a, b, at_least, cell)
        alike = pairs.orderBy(F.desc("score"), "name_l", "name_r").limit(n).select("id_l", "id_r")
        found = _scored(alike, left, right, measure).agg(
            F.max("score"), F.sum(F.size("name_l").cast("bigint") * F.size("name_r"))).first()
        if found[1]:
            radius, held = found
        if held >= n:
            break
    return radius, held


def _unscored(left, right, known_left, known_right, n):
    """The first ``n`` pairs, by name, in which a side has no known word.

    Such a pair is a left name without known words next to any right name, or any left name next to a
    right one without. The first ``n`` pairs hold no more than the first ``n`` names of either side.
    """
    def names(df, known, column):
        return df.select(F.col(column).alias("name")).where(F.col(column).isNotNull()).distinct().join(
            known.select(F.explode("name").alias("name"), F.lit(True).alias("known")), "name", "left")

    (left, left_column), (right, right_column) = left, right
    lefts, rights = names(left, known_left, left_column), names(right, known_right, right_column)

    def first(df):
        kept = df.orderBy("name").limit(n).agg(F.array_sort(F.collect_list("name")))
        return kept.scalar()

    partners = F.when(F.col("known").isNull(), first(rights)).otherwise(first(rights.where("known IS NULL")))
    spread = lefts.select("name", partners.alias("partners")).where(F.size("partners") > 0).orderBy("name").limit(n)
    pairs = spread.select(F.col("name").alias("left"), F.explode("partners").alias("right"))
    return pairs.select("left", "right", F.lit(None).cast("double").alias("distance")).orderBy("left", "right").limit(n)


def relaxed_top(left, right, vectors, n=1000, left_column="BusinessType", right_column="BusinessType",
                stop_words=STOP_WORDS, digits=9, cell=CELL):
    """The ``n`` closest pairs of types by relaxed word-mover distance, ties by name.

    Up to ``n`` pairs alike by their words give a radius that surely holds as many pairs; where that is
    not enough, the radius doubles until it is or spans all vectors. Distances are rounded to ``digits``
    so that ties do not hang on the last bits. Types without any known word have no distance: their
    pairs come last, with NULL, when there are fewer than ``n`` others.
    """
    bags = [_bags(df, c, stop_words, False, n) for df, c in ((left, left_column), (right, right_column))]
    sides = (left, left_column), (right, right_column)
    lexicon = _lexicon(*bags, vectors)
    if lexicon is None:
        return _unscored(*sides, *(bag.limit(0) for bag in bags), n)
    a, b = (_weighted(bag, lexicon) for bag in bags)
    widest, typical = _distances(lexicon)
    radius, sure = _first_radius(a, b, n, widest, cell)
    # room for pairs that round to the same distance as the last one
    radius += 10.0**-digits
    while True:
        pairs = _relaxed_join(a, b, lexicon, min(radius, widest), typical, cell)
        best = cut(_best_names(pairs.withColumn("score", F.round("score", digits)), n, ascending=True))
        best = best.select("left", "right", F.col("score").alias("distance"))
        inside = F.col("distance") < radius - 10.0**-digits
        if sure >= n or best.where(inside).count() == n:
            return best
        if radius >= widest:
            rest = _unscored(*sides, a, b, n - best.count()) if best.count() < n else None
            return best if rest is None else best.unionByName(rest).orderBy(F.asc_nulls_last("distance"), "left", "right")
        radius *= 2


def mover_pairs(left, right, vectors, within, left_column="BusinessType", right_column="BusinessType",
                stop_words=STOP_WORDS, cell=CELL):
    """All pairs of types with a word-mover distance of at most ``within``.

    The relaxed distance is a lower bound, so only pairs within it by that are solved.
    """
    a, b = _bags(left, left_column, stop_words, False), _bags(right, right_column, stop_words, False)
    lexicon = _lexicon(a, b, vectors)
    if lexicon is None:
        return _nothing(left.sparkSession)
    _, typical = _distances(lexicon)
    a, b = _weighted(a, lexicon), _weighted(b, lexicon)
    bounded = _relaxed_join(a, b, lexicon, within + SMALL, typical, cell).select("id_l", "id_r")
    found = _scored(bounded, a, b, _exact).where(F.col("score") <= within + SMALL)
    return found.select(F.col("name_l").alias("left"), F.col("name_r").alias("right"), F.col("score").alias("distance"))


def _solved(bounded, left, right, n, digits):
    """Word-mover distances of the pairs that may be among the ``n`` closest, from their relaxed distances.

    The ``n`` pairs closest by the lower bound are solved first; of the others only those whose bound does not exceed
    the largest distance found.
    """
    order = ["score", F.element_at("name_l", 1), F.element_at("name_r", 1)]
    first = cut(bounded.orderBy(*order).limit(n).select("id_l", "id_r"))
    solved = cut(_scored(first, left, right, _exact))
    names = F.sum(F.size("name_l").cast("bigint") * F.size("name_r"))
    largest, held = solved.agg(F.max("score"), names).first()
    rest = bounded if (held or 0) < n else bounded.where(F.col("score") <= largest + 10.0**-digits)
    rest = rest.select("id_l", "id_r").join(first, ["id_l", "id_r"], "left_anti")
    return cut(solved.unionByName(_scored(rest, left, right, _exact)))


def mover_top(left, right, vectors, n=1000, left_column="BusinessType", right_column="BusinessType",
              stop_words=STOP_WORDS, digits=9, cell=CELL, report=None):
    """The ``n`` closest pairs of types by word-mover distance, ties by name.

    As ``relaxed_top``, with the exact distance: the relaxed one is a lower bound, so pairs beyond the radius by it are
    beyond it, and of the others ``_solved`` solves those that the bound does not exclude. A dictionary ``report`` receives
    the number of pairs that were bounded and solved. Types without any known word come last, with NULL.
    """
    bags = [_bags(df, c, stop_words, False, n) for df, c in ((left, left_column), (right, right_column))]
    sides = (left, left_column), (right, right_column)
    lexicon = _lexicon(*bags, vectors)
    if lexicon is None:
        return _unscored(*sides, *(bag.limit(0) for bag in bags), n)
    a, b = (_weighted(bag, lexicon) for bag in bags)
    widest, typical = _distances(lexicon)
    radius, sure = _first_radius(a, b, n, widest, cell, _exact)
    radius += 10.0**-digits
    while True:
        bounded = cut(_relaxed_join(a, b, lexicon, min(radius, widest), typical, cell))
        solved = _solved(bounded, a, b, n, digits)
        if report is not None:
            report.update(bounded=bounded.count(), solved=solved.count())
        best = cut(_best_names(solved.withColumn("score", F.round("score", digits)), n, ascending=True))
        best = best.select("left", "right", F.col("score").alias("distance"))
        inside = F.col("distance") < radius - 10.0**-digits
        if sure >= n or best.where(inside).count() == n:
            return best
        if radius >= widest:
            rest = _unscored(*sides, a, b, n - best.count()) if best.count() < n else None
            return best if rest is None else best.unionByName(rest).orderBy(F.asc_nulls_last("distance"), "left", "right")
        radius *= 2
