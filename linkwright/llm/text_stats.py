"""Counts over whole texts, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def removed(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def with_counts(docs: DataFrame, text: str = "text", distinct: bool = False) -> DataFrame:
    """Add the base counts of ``text`` to each row (all long; 0 for null texts).

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a
    word), n_dup_lines (of these, equal to an earlier line) and n_repeat_words
    (words inside 3-word windows that occur twice or more in the text).

    Repeated windows are found without leaving the row: each window becomes a
    long whose high bits are a hash of its words and whose low bits, as many as
    the text's word count needs, are its place; after sorting, windows with an
    equal neighbour are the repeated ones.  The hash keeps 64 bits less those of
    the word count, so that two unlike windows of a text of 20,000 words agree
    with a chance of about 4e-7.  With ``distinct``, n_distinct counts unlike words
    by their 64-bit hashes.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_words", words(body)).withColumn("_lines", lines)
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
            "n_symbols": removed(body, SYMBOLS),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
            "_mask": F.expr("shiftleft(1L, length(bin(size(_words)))) - 1"),
        }
    ).drop("_words", "_lines")
    if distinct:
        out = out.withColumn("n_distinct", F.size(F.array_distinct("_hashes")).cast("long"))
    packed = F.transform(
        F.slice("_hashes", 1, F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")),
        lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)).bitwiseAND(F.bitwise_not("_mask")).bitwiseOR(i.cast("long")),
    )
    out = out.withColumn("_sorted", F.sort_array(packed)).drop("_hashes")
    same = lambda a, b: a.bitwiseOR(F.col("_mask")) == b.bitwiseOR(F.col("_mask"))
    twice = F.filter("_sorted", lambda x, i: same(x, F.get("_sorted", i + 1)) | same(x, F.get("_sorted", i - 1)))
    out = out.withColumn("_twice", twice).drop("_sorted")
    out = out.withColumn("_at", F.sort_array(F.transform("_twice", lambda x: x.bitwiseAND(F.col("_mask"))))).drop("_twice", "_mask")
    steps = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(3).cast("long"), F.get("_at", i + 1) - p)), F.lit(0).cast("long"), lambda a, s: a + s
    )  # the last place has no next one: least() skips the null and gives 3
    return out.withColumn("n_repeat_words", steps).drop("_at")


#: The same counts in DuckDB SQL, from a table ``documents``.
COUNTS_SQL = r"""
texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS body FROM documents),
split_texts AS (
  SELECT *, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM texts),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split_texts)),
twice AS (
  SELECT doc_id, i FROM windows JOIN (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
    (len(body) - len(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split_texts LEFT JOIN covered USING (doc_id))
"""
