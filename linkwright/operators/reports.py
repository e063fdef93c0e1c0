"""Statistics of records, true pairs and missed pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions import similarity as S
from linkwright.functions.fuzzy import similarities
from linkwright.functions.text import tokens
from linkwright.operators.features import sided

# Patterns whose share of texts is reported.
LEGAL_PATTERNS = {
    "sarl": r"\bsarl\b", "sas": r"\bsas\b", "eurl": r"\beurl\b", "sa": r"\bsa\b", "sasu": r"\bsasu\b", "sci": r"\bsci\b",
    "company or society": r"\b(cie|societe)\b", "association": r"\bassociation\b", "snc": r"\bsnc\b", "sca or gie": r"\b(sca|gie)\b",
}
STREET_PATTERNS = {
    "street": r"\brue\b", "avenue": r"\b(avenue|av)\b", "alley": r"\b(allée|allee)\b", "boulevard": r"\b(boulevard|bd)\b",
    "dead end": r"\bimpasse\b", "road": r"\b(route|rte)\b", "path": r"\bchemin\b", "square": r"\b(place|pl)\b", "business mail": r"\bcedex\b",
}
POSTAL_PATTERNS = {"five digits": r"\b([0-9]{5})\b", "five digits or nine": r"\b([0-9]{5}(?:-[0-9]{4})?)\b", "six digits": r"\b([1-9][0-9]{5})\b"}
NUMBER_PATTERN = r"(?i)\b(?:\#|no\.?|plot|flat|door|shop|h\.?no)?\s*[0-9]+[a-z]?\b"
ACCENTS = "[éèêëàâîïôùûçÉÈÊËÀÂÎÏÔÙÛÇ]"
WRITING_PATTERNS = {"number": NUMBER_PATTERN, "accent": ACCENTS}
DISCREPANCIES = ("subset", "typo", "word order", "shared core", "moderate", "heavy")


def pattern_shares(df: DataFrame, column: str, patterns: dict[str, str], lower: bool = True) -> DataFrame:
    """(pattern, n, percent) of rows whose text has each pattern, in one pass."""
    c = F.coalesce(F.lower(column) if lower else F.col(column), F.lit(""))
    one = df.agg(F.array(*[F.struct(F.lit(k).alias("pattern"), F.count(F.when(c.rlike("(?U)" + p), 1)).alias("n")) for k, p in patterns.items()]).alias("_s"), F.count("*").alias("_all"))
    return one.select(F.explode("_s").alias("_s"), "_all").select("_s.pattern", "_s.n", F.coalesce(100 * F.try_divide("_s.n", "_all"), F.lit(0.0)).alias("percent"))


def token_presence(df: DataFrame, column: str, wanted: list[str] | None = None) -> DataFrame:
    """(token, n): rows that have each token, once a row."""
    each = df.select(F.explode_outer(F.array_distinct(tokens(F.col(column)))).alias("token")).filter("token IS NOT NULL")  # outer: no filter that splits twice
    if wanted is not None:
        each = each.filter(F.col("token").isin(wanted))
    return each.groupBy("token").agg(F.count("*").alias("n"))


def most_common(df: DataFrame, column: str, n: int = 10, empty: str = "(none)") -> DataFrame:
    """(value, n): the n most frequent values; ties by value."""
    value = F.when(F.col(column) == "", empty).otherwise(F.col(column))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def percent(c: Column) -> Column:
    return F.coalesce(100 * F.avg(F.coalesce(c, F.lit(False)).cast("double")), F.lit(0.0))


def agreement(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """One row: how often true pairs agree, in percent, by each normal form and by name and address together.

    A pair whose names agree and whose addresses are both empty is in none of the
    last four classes.
    """
    df = sided(pairs, records, ["name_norm", "name_core", "name_key", "name_compact", "addr_key"])
    same = lambda c: F.col(f"l_{c}") == F.col(f"r_{c}")
    name, addr, there = same("name_key"), same("addr_key"), F.col("l_addr_key") != ""
    return df.agg(
        F.count("*").alias("pairs"), *[percent(same(c)).alias(c) for c in ("name_norm", "name_core", "name_key", "name_compact")],
        percent(addr & there).alias("addr_key"), percent(name | (addr & there)).alias("either"),
        percent(name & addr & there).alias("both_agree"), percent(name & ~addr).alias("name_agrees"),
        percent(~name & addr & there).alias("addr_agrees"), percent(~name & ~addr).alias("both_differ"),
    )


def residual(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """True pairs of unlike name keys, with similarities of their names (0 to 100) and the class of their difference."""
    df = sided(pairs, records, ["name_norm", "name_key"]).filter("l_name_key <> r_name_key")
    a, b = F.col("l_name_norm"), F.col("r_name_norm")
    df = df.withColumn("_f", similarities([("n", "ratio"), ("n", "token_sort"), ("n", "token_set")], {"n": (a, b)}))
    score = lambda c: 100 * F.coalesce(c, F.lit(0.0))
    df = df.withColumns(
        {
            "ratio": score(F.col("_f.n_ratio")), "token_sort": score(F.col("_f.n_token_sort")), "token_set": score(F.col("_f.n_token_set")),
            "token_jaccard": score(S.plain_token_jaccard(a, b)), "char_ngram": score(S.plain_gram_jaccard(a, b)),
        }
    )
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    subset = (F.size(x) > 0) & (F.size(y) > 0) & ((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0))
    kind = F.when(subset, "subset").when(F.col("ratio") >= 85, "typo").when(F.col("token_sort") >= 85, "word order")
    kind = kind.when(F.col("token_set") >= 85, "shared core").when(F.col("ratio") >= 60, "moderate").otherwise("heavy")
    return df.withColumn("discrepancy", kind).drop("_f")


def discrepancies(gap: DataFrame) -> DataFrame:
    """(discrepancy, n) of residual pairs."""
    return gap.groupBy("discrepancy").agg(F.count("*").alias("n"))


def discrepancy_table(gap: DataFrame) -> DataFrame:
    """(discrepancy, n, percent) of residual pairs, in percent of all of them."""
    return discrepancies(gap).crossJoin(F.broadcast(gap.agg(F.count("*").alias("_all")))).select("discrepancy", "n", (100 * F.col("n") / F.col("_all")).alias("percent"))


def unshared_tokens(gap: DataFrame, most: int = 10) -> DataFrame:
    """(discrepancy, token, n): the ``most`` tokens of each class that are on one side of its pairs only, by pairs; ties by token."""
    x, y = F.array_distinct(tokens(F.col("l_name_norm"))), F.array_distinct(tokens(F.col("r_name_norm")))
    each = gap.select("discrepancy", F.explode(F.concat(F.array_except(x, y), F.array_except(y, x))).alias("token"))
    counts = each.groupBy("discrepancy", "token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("discrepancy").orderBy(F.desc("n"), "token"))
    return counts.withColumn("_r", rank).filter(F.col("_r") <= most).drop("_r")


def metric_means(gap: DataFrame) -> DataFrame:
    """(metric, mean) of residual pairs."""
    names = ("ratio", "token_sort", "token_set", "token_jaccard", "char_ngram")
    return reduce(DataFrame.unionByName, [gap.agg(F.avg(n).alias("mean")).select(F.lit(n).alias("metric"), "mean") for n in names])


def missed(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """True pairs (s1_id, cand_id) that aren't candidates."""
    return truth.select("s1_id", "cand_id").distinct().join(candidates.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")


def missed_with_records(truth: DataFrame, candidates: DataFrame, records: DataFrame, n: int = 25) -> DataFrame:
    """A look at ``n`` missed pairs with both records."""
    some = missed(truth, candidates).orderBy("s1_id", "cand_id").limit(n)
    return sided(some, records, ["name_norm", "name_key", "addr_norm", "country"])
