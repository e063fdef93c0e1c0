"""Similarities as plain column expressions; null where a side is empty, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwright.functions import wordlists as L
from linkwright.functions.text import DIGITS, text, tokens


def if_both(a: Column, b: Column, out: Column) -> Column:
    return F.when((text(a) != "") & (text(b) != ""), out)


def equal(a: Column, b: Column) -> Column:
    return if_both(a, b, (a == b).cast("double"))


def set_jaccard(x: Column, y: Column) -> Column:
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def token_jaccard(a: Column, b: Column) -> Column:
    x, y = tokens(a), tokens(b)
    return if_both(a, b, F.when((F.size(x) > 0) | (F.size(y) > 0), set_jaccard(x, y)))


def grams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams; a shorter text is its only one."""
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substr(c, i, F.lit(n)))
    return F.array_distinct(each)


def gram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    return if_both(a, b, set_jaccard(grams(a, n), grams(b, n)))


def size_ratio(x: Column, y: Column) -> Column:
    return F.try_divide(F.least(x, y), F.greatest(x, y))


def length_ratio(a: Column, b: Column) -> Column:
    return if_both(a, b, size_ratio(F.length(a), F.length(b)))


def token_count_ratio(a: Column, b: Column) -> Column:
    return if_both(a, b, size_ratio(F.size(tokens(a)), F.size(tokens(b))))


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length."""
    return if_both(a, b, 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def proper_suffix(a: Column, b: Column) -> Column:
    """1 if the shorter of two unlike texts, of two characters or more, ends the longer."""
    short = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    long = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return if_both(a, b, ((a != b) & (F.length(short) >= 2) & long.endswith(short)).cast("double"))


def landmarks(addr_norm: Column) -> Column:
    """Tokens that follow a landmark marker within two places, less markers and numbers, as one text."""
    toks = tokens(addr_norm)
    after = F.transform(
        toks, lambda t, i: F.when(t.isin(L.LANDMARKS), F.filter(F.slice(toks, i + 2, F.lit(2)), lambda x: ~x.isin(L.LANDMARKS) & ~x.rlike(DIGITS)))
    )
    return F.array_join(F.flatten(F.filter(after, lambda x: x.isNotNull())), " ")


# Forms of the older extractor: 0 rather than null where a side is empty.


def plain_token_jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(token_jaccard(a, b), F.lit(0.0))


def plain_gram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    short = (F.length(a) < n) | (F.length(b) < n)
    return F.when(short, ((a == b) & (a != "")).cast("double")).otherwise(set_jaccard(grams(a, n), grams(b, n)))
