"""Text cleaning, tokens and token-set similarity."""

import string

from pyspark.sql import functions as F

from permitry.schemas import STOP_WORDS


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def blank_if_null(c):
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def is_blank(c):
    """NULL or the empty string: the two ways a CSV cell can be empty."""
    return F.coalesce(_col(c) == "", F.lit(True))


def glue(first, second, separator=" "):
    """``first + separator + second``; the separator stays when a part is NULL."""
    return F.concat(blank_if_null(first), F.lit(separator), blank_if_null(second))


def type_key(business_type, sub_type):
    """Type and subtype as one text; NULL type gives NULL, NULL subtype a trailing space."""
    return F.concat(_col(business_type), F.lit(" "), F.coalesce(_col(sub_type), F.lit("")))


def address_text(*parts):
    """Non-NULL address parts joined by a space, the text a geocoder is asked for."""
    return F.concat_ws(" ", *[_col(p) for p in parts])


def quotes_to_space(c):
    return F.translate(_col(c), '"', " ")


def separators_to_space(c):
    """Comma and double quote both become a space."""
    return F.translate(_col(c), ',"', "  ")


def drop_quotes(c, comma_to_space=False):
    """Delete double quotes; the draft form also turns commas into spaces."""
    return F.translate(_col(c), ',"' if comma_to_space else '"', " " if comma_to_space else "")


def is_number(c):
    """True for text that reads as a decimal number, an infinity or not-a-number; NULL is False."""
    number = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
    return F.coalesce(_col(c).rlike(number), F.lit(False))


def words(c):
    """Lower-case ASCII words of a text in order, with an empty one where it starts or ends otherwise."""
    lower = F.translate(_col(c), string.ascii_uppercase, string.ascii_lowercase)
    return F.split(lower, "[^a-z0-9]+")


def is_token(word, stop_words=STOP_WORDS):
    """A word that is neither empty nor a stop word."""
    return ~word.isin("", *stop_words)


def tokens(c, stop_words=STOP_WORDS):
    """Lower-case ASCII words of a text without stop words, in order, repeats kept; NULL gives []."""
    kept = F.filter(words(c), lambda w: is_token(w, stop_words))
    return F.coalesce(kept, F.array().cast("array<string>"))


def jaccard(a, b):
    """Shared over all distinct tokens; 0 when either side is empty."""
    a, b = _col(a), _col(b)
    either_empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(either_empty, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    )


def same_type(a, b):
    """Case-insensitive equality of two business types."""
    return F.lower(_col(a)) == F.lower(_col(b))
