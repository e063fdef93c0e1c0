"""Normalisation of names and addresses as column expressions, without Python in the executors."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwright.functions import wordlists as L


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def tokens(c: Column) -> Column:
    """Tokens between white space; none for an empty text."""
    return F.array_remove(F.split(c, r"(?U)\s+"), "")


def joined(c: Column, by: str = " ") -> Column:
    return F.array_join(c, by)


def distinct_sorted(c: Column) -> Column:
    """The set of tokens as one text, independent of order and repetition."""
    return joined(F.sort_array(F.array_distinct(c)))


def listed(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def mapping(values: dict[str, str]) -> Column:
    """A constant map; one expression whatever its size."""
    return F.str_to_map(F.lit("\x1e".join(f"{k}\x1d{v}" for k, v in values.items())), F.lit("\x1e"), F.lit("\x1d"))


def first_or_empty(c: Column) -> Column:
    return F.coalesce(F.get(c, F.lit(0)), F.lit(""))


@functools.cache
def decompositions() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions less U+0300-036F: one-to-one as two strings, the others as a map.

    Built by rule over the basic plane; Hangul syllables and CJK compatibility
    ideographs are left as they are.
    """
    one_from, one_to, many = [], [], {}
    for cp in range(0xA0, 0xFFFE):
        if 0xAC00 <= cp <= 0xFAFF or 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = "".join(x for x in unicodedata.normalize("NFKD", ch) if not "̀" <= x <= "ͯ")
        if out == ch:
            continue
        if len(out) == 1:
            one_from.append(ch)
            one_to.append(out)
        else:
            many[ch] = out
    return "".join(one_from), "".join(one_to), many


def per_character(c: Column, table: dict[str, str], only_if: Column) -> Column:
    """Each character replaced by its text in a table, where a text has one of them."""
    spelled = joined(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(mapping(table), ch), ch)), "")
    return F.when(only_if, spelled).otherwise(c)


def unaccent(c: Column) -> Column:
    """Compatibility decomposition without combining Latin marks, then lower case."""
    one_from, one_to, many = decompositions()
    c = F.translate(c, one_from, one_to)
    low = "".join(re.escape(ch) for ch in many if ch < "ɐ")
    c = per_character(c, many, c.rlike(rf"[{low}\x{{0250}}-\x{{FFFF}}]"))  # a short class: texts in Latin letters pass at once
    return F.lower(F.regexp_replace(c, "[̀-ͯ]", ""))


def only_letters(c: Column) -> Column:
    """Characters other than letters, digits and marks of any script become spaces; spaces collapse."""
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\p{M}]+", " ")
    return F.trim(c)


def base_clean(c: Column) -> Column:
    return only_letters(F.replace(unaccent(text(c)), F.lit("&"), F.lit(" and ")))


def script_of(c: Column) -> Column:
    """latin, or the script of the first letter beyond Latin Extended-B (``other`` for scripts not told apart)."""
    letter = F.regexp_extract(c, r"([\p{L}&&[^\x{0000}-\x{024F}]])", 1)
    out = F.when((letter == "") | letter.rlike(r"\p{IsLatin}"), "latin").when(letter.rlike(r"\p{IsHan}"), "cjk")
    for s in L.SCRIPTS:
        out = out.when(letter.rlike(rf"\p{{Is{s}}}"), s.lower())
    return out.otherwise("other")


def hangul(c: Column) -> Column:
    """Korean syllables in Latin letters: a syllable's place in its block tells its three parts."""
    part = lambda k, at: F.element_at(F.array(*[F.lit(x) for x in L.HANGUL[k]]), at + 1)

    def spelled(ch: Column) -> Column:
        n = F.ascii(ch) - 0xAC00
        return F.when(ch.between("가", "힣"), F.concat(part(0, F.floor(n / 588).cast("int")), part(1, F.floor(n % 588 / 28).cast("int")), part(2, (n % 28).cast("int")))).otherwise(ch)

    return F.when(c.rlike("[가-힣]"), joined(F.transform(F.split(c, ""), spelled), "")).otherwise(c)


def romanise(c: Column) -> Column:
    """Letters of the Brahmic scripts (without inherent vowels), Cyrillic, Greek, Arabic, Hebrew and Hangul in Latin letters."""
    table = {chr(b + o): v for b in L.BRAHMIC_BLOCKS for o, v in L.BRAHMIC.items()}
    table |= {chr(b + 0x66 + d): str(d) for b in L.BRAHMIC_BLOCKS for d in range(10)}
    c = per_character(c, table, c.rlike(r"[\x{0900}-\x{0D7F}]"))
    letters = {**L.CYRILLIC, **L.GREEK, **L.ARABIC, **L.HEBREW}
    letters |= {k.upper(): v for k, v in letters.items() if len(k.upper()) == 1}
    return hangul(per_character(c, letters, c.rlike(r"[\x{0370}-\x{06FF}]")))


def fix_digits(c: Column) -> Column:
    """Digits read for letters, in words of four characters or more.

    A digit counts as a letter between two letters, or before three at a word's
    start.  All such digits are marked first, so that each is judged by its
    neighbours in the text as it came.
    """
    d = "[" + "".join(L.DIGIT_LETTERS) + "]"
    at = rf"(?<![^ ]){d}(?=\p{{L}}{{3}})|(?<=[^ ]\p{{L}}){d}(?=\p{{L}})|(?<=\p{{L}}){d}(?=\p{{L}}[^ ])"
    c = F.regexp_replace(c, at, "\x01$0")
    for digit, letter in L.DIGIT_LETTERS.items():
        c = F.replace(c, F.lit("\x01" + digit), F.lit(letter))
    return c


DOMAIN = r"(?i)^\s*(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:%s)\s*/?\s*$" % "|".join(re.escape(d) for d in L.DOMAINS)
#: A letter's dot inside a run of two or more letters with dots.
DOTTED = r"\b([A-Za-z])\.(?=[A-Za-z]\.)|(?<=\b[A-Za-z]\.)([A-Za-z])\."


def name_fields(raw: Column) -> list[dict[str, Column]]:
    """The normal forms of a name, in layers: each refers to the columns of those before it."""
    toks = F.col("_toks")
    compact = F.col("_compact")
    cut = compact
    for tail in reversed(L.DOMAIN_TAILS):
        cut = F.when(compact.endswith(tail) & (F.length(compact) > len(tail) + 2), F.left(compact, F.length(compact) - len(tail))).otherwise(cut)
    named = F.when(F.col("_host") != "", F.replace("_host", F.lit("-"), F.lit(" "))).otherwise(F.col("_n"))
    return [
        {"name_script": script_of(text(raw))},
        {"_n": F.when(F.col("name_script") != "latin", romanise(text(raw))).otherwise(text(raw))},
        {"_host": F.regexp_extract("_n", DOMAIN, 1)},
        {"name_is_domain": (F.col("_host") != "").cast("int"), "_toks": tokens(fix_digits(base_clean(F.regexp_replace(named, DOTTED, "$1$2"))))},
        {"_kept": F.filter(toks, lambda t: ~t.isin([*L.LEGAL, *L.DROPPED])), "_plain": F.filter(toks, lambda t: ~t.isin(L.DROPPED))},
        {"_core": F.when(F.size("_kept") > 0, F.col("_kept")).when(F.size("_plain") > 0, F.col("_plain")).otherwise(toks)},
        {"_compact": joined(F.col("_core"), "")},
        {
            "name_norm": joined(toks), "name_core": joined(F.col("_core")), "name_key": distinct_sorted(F.col("_core")),
            "name_compact": F.when(F.col("name_is_domain") == 1, cut).otherwise(compact),
            "legal": joined(F.sort_array(F.array_intersect(toks, listed(L.LEGAL)))),
        },
    ]


LABEL = r"(?U)\b(?:h\s*\.?\s*no|house\s*no|door\s*no|dor\s*no|flat\s*no|plot\s*no|shop\s*no)\b\.?"
DIGITS = r"^\p{Nd}+$"


def postal_of(toks: Column) -> Column:
    """The postal code among a segment's tokens, or null.

    Six digits that don't start with 0, or else five digits that stand alone, beside
    a two-letter word, or first without a street word or number among the others.
    """
    street = lambda x: x.isin(L.STREET_WORDS) | x.rlike(DIGITS)
    six = F.get(F.filter(toks, lambda t: t.rlike(r"^\p{Nd}{6}$") & ~t.startswith("0")), F.lit(0))
    n = F.size(toks)

    def five(t: Column, i: Column) -> Column:
        pair = (n == 2) & F.exists(toks, lambda x: x.rlike(r"^\p{L}{2}$"))
        rest = F.slice(toks, 2, F.greatest(n - 1, F.lit(0)))
        return t.rlike(r"^\p{Nd}{5}$") & ((n == 1) | pair | ((i == 0) & ~F.exists(rest, street)))

    return F.coalesce(six, F.get(F.filter(toks, five), F.lit(0)))


def address_fields(raw: Column) -> list[dict[str, Column]]:
    """The normal forms of an address, in layers as in ``name_fields``."""
    s = F.when(script_of(text(raw)) != "latin", romanise(text(raw))).otherwise(text(raw))
    s = F.regexp_replace(F.replace(unaccent(s), F.lit("#"), F.lit(" ")), LABEL, " ")
    forms, states = mapping(L.ADDRESS_FORMS), mapping(L.STATES)
    canon = lambda t: F.coalesce(F.try_element_at(forms, t), t)
    unpadded = lambda t: F.when(t.rlike(DIGITS), F.regexp_replace(t, r"^0+(?=.)", "")).otherwise(t)
    known = lambda k: F.coalesce(F.get(F.filter(F.slice("_postals", 1, k + 1), lambda p: p.isNotNull()), F.lit(0)), F.lit(""))
    numbers = lambda toks, k: F.filter(toks, lambda t: t.rlike(DIGITS) & (t != known(k)))
    on_street = F.filter("_nums", lambda n, k: (F.size(n) > 0) & F.arrays_overlap(F.get("_segs", k), listed(L.STREET_WORDS)))
    return [
        {"_parts": F.filter(F.transform(F.split(s, ","), only_letters), lambda x: x != "")},
        {"_named": F.transform("_parts", lambda x: F.coalesce(F.try_element_at(states, x), x))},
        {
            "state": first_or_empty(F.filter("_named", lambda x: x.isin(L.STATE_CODES))),
            "_raw": F.transform("_named", lambda x: F.transform(F.filter(F.split(x, " "), lambda t: ~t.isin(L.ADDRESS_NOISE)), canon)),
        },
        {"_postals": F.transform("_raw", postal_of), "_segs": F.transform("_raw", lambda toks: F.transform(toks, unpadded))},
        {"postal": first_or_empty(F.filter("_postals", lambda p: p.isNotNull())), "_nums": F.transform("_segs", numbers), "_words": F.flatten("_segs")},
        {"_all": F.flatten("_nums")},
        {
            "house_no": F.coalesce(F.get(F.get(on_street, F.lit(0)), F.lit(0)), F.get("_all", F.lit(0)), F.lit("")),
            "addr_norm": joined(F.col("_words")), "addr_key": distinct_sorted(F.col("_words")), "numbers": distinct_sorted(F.col("_all")),
            "addr_empty": (F.size("_words") == 0).cast("int"),
        },
    ]


# The older cleaner, which expands abbreviations.


def _expanded(c: Column, table: list[tuple[str, str]]) -> Column:
    c = F.lower(F.trim(text(c)))
    for short, long in table:
        c = F.replace(c, F.lit(short), F.lit(long)) if short == "&" else F.regexp_replace(c, rf"(?U)\b{short}\b", long)
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def clean_name(c: Column) -> Column:
    return _expanded(c, L.NAME_EXPANSIONS)


def clean_address(c: Column) -> Column:
    return _expanded(c, L.ADDRESS_EXPANSIONS)


def postal_code(c: Column, country: Column) -> Column:
    """Six digits not starting with 0 in India, five in the US and France; null elsewhere or without one."""
    where = F.upper(F.trim(text(country)))
    six = F.regexp_extract(text(c), r"(?U)\b([1-9][0-9]{5})\b", 1)
    five = F.regexp_extract(text(c), r"(?U)\b([0-9]{5})\b", 1)
    return F.nullif(F.when(where == "INDIA", six).when(where.isin("US", "FRANCE"), five), F.lit(""))


# Tokens and keys for blocking.


def _lowered(c: Column) -> Column:
    return F.lower(F.trim(text(c)))


def blocking_tokens(c: Column, stop_words: list[str] = L.STOP_WORDS, lower: bool = True) -> dict[str, Column]:
    """w1 and w2: the first two telling tokens (w1: else the first token); p3: w1's first three characters."""
    toks = tokens(_lowered(c) if lower else text(c))
    telling = F.filter(toks, lambda t: (F.length(t) >= 3) & ~t.isin(stop_words))
    w1 = F.coalesce(F.get(telling, F.lit(0)), F.get(toks, F.lit(0)), F.lit(""))
    return {"w1": w1, "w2": F.coalesce(F.get(telling, F.lit(1)), F.lit("")), "p3": F.substring(w1, 1, 3)}


def name_stem(c: Column) -> Column:
    toks = tokens(_lowered(c))
    telling = F.filter(toks, lambda t: (F.length(t) >= 3) & ~t.isin(L.GENERIC_WORDS))
    return F.when(F.size(telling) > 0, joined(F.slice(telling, 1, 2))).otherwise(first_or_empty(toks))


def street_word(c: Column) -> Column:
    return first_or_empty(F.filter(tokens(_lowered(c)), lambda t: ~t.rlike(DIGITS) & (F.length(t) >= 3) & ~t.isin(L.STREET_NOISE)))


def both(a: Column, b: Column) -> Column:
    """``a_b``, or empty if either is."""
    return F.when((a != "") & (b != ""), F.concat_ws("_", a, b)).otherwise("")


# Ids.


def id_to_number(c: Column) -> Column:
    """Source digit times 10**11 plus the number; null for ids of another form."""
    found = lambda k: F.regexp_extract(c, r"^S([0-9])-([0-9]+)$", k)
    return F.when(found(1) != "", found(1).try_cast("long") * F.lit(10**11) + found(2).try_cast("long"))


def number_to_id(c: Column) -> Column:
    """The id of a number; zero padding isn't restored."""
    return F.concat(F.lit("S"), F.floor(c / F.lit(10**11)).cast("string"), F.lit("-"), (c % F.lit(10**11)).cast("string"))


def id_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(text(c), ","), F.trim), lambda x: x != "")
