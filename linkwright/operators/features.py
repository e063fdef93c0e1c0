"""Features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions import similarity as S
from linkwright.functions.fuzzy import similarities
from linkwright.functions.text import clean_address, clean_name, postal_code, text

FUZZY = [
    ("name", "ratio"), ("name", "token_sort"), ("name", "token_set"), ("name", "partial"), ("name", "jaro_winkler"),
    ("compact", "ratio"), ("addr", "ratio"), ("addr", "token_set"), ("addr", "token_sort"),
]
USED = "name_core name_key name_compact legal name_is_domain name_script addr_norm addr_key house_no numbers state postal addr_empty".split()


def sided(pairs: DataFrame, records: DataFrame, columns: list[str], check: bool = False) -> DataFrame:
    """Pairs (s1_id, cand_id, ...) with both records' columns as l_* and r_*."""
    records = records.select("entity_id", *columns).dropDuplicates(["entity_id"])
    out, how = pairs, "left" if check else "inner"
    for key, p in (("s1_id", "l"), ("cand_id", "r")):
        side = records.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in columns], F.lit(True).alias(f"{p}_found"))
        out = out.join(side, key, how)
    if check:
        lost = out.filter("l_found IS NULL OR r_found IS NULL").select("s1_id", "cand_id").limit(5).collect()
        if lost:
            raise ValueError(f"pairs with ids that have no record, such as {[tuple(r) for r in lost]}")
    return out.select(*pairs.columns, *[f"{p}_{c}" for p in "lr" for c in columns])


def pair_features(pairs: DataFrame, records: DataFrame, check: bool = False) -> DataFrame:
    """The 31 features of each pair (all double), null where a side has nothing to compare."""
    df = sided(pairs, records, USED, check)
    l, r = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))  # noqa: E741
    two = lambda f, c: f(l(c), r(c))
    df = df.withColumn("_f", similarities(FUZZY, {"name": (l("name_core"), r("name_core")), "compact": (l("name_compact"), r("name_compact")), "addr": (l("addr_norm"), r("addr_norm"))}))
    flag = lambda c: c.cast("double")
    features: dict[str, Column] = {
        "name_key_eq": two(S.equal, "name_key"), "name_compact_eq": two(S.equal, "name_compact"),
        "name_ratio": F.col("_f.name_ratio"), "name_token_sort": F.col("_f.name_token_sort"), "name_token_set": F.col("_f.name_token_set"),
        "name_partial": F.col("_f.name_partial"), "name_jw": F.col("_f.name_jaro_winkler"),
        "name_tok_jacc": two(S.token_jaccard, "name_key"), "name_3gram_jacc": two(S.gram_jaccard, "name_compact"),
        "name_compact_ratio": F.col("_f.compact_ratio"), "name_len_ratio": two(S.length_ratio, "name_core"),
        "name_ntok_ratio": two(S.token_count_ratio, "name_core"), "legal_agree": two(S.token_jaccard, "legal"),
        "cand_is_domain": flag(r("name_is_domain")), "script_diff": flag(l("name_script") != r("name_script")),
        "cand_non_latin": flag(r("name_script") != "latin"),
        "addr_key_eq": two(S.equal, "addr_key"), "addr_ratio": F.col("_f.addr_ratio"), "addr_token_set": F.col("_f.addr_token_set"),
        "addr_token_sort": F.col("_f.addr_token_sort"), "addr_tok_jacc": two(S.token_jaccard, "addr_key"), "addr_len_ratio": two(S.length_ratio, "addr_norm"),
        "house_eq": two(S.equal, "house_no"), "house_suffix": two(S.proper_suffix, "house_no"), "house_sim": two(S.edit_similarity, "house_no"),
        "numbers_jacc": two(S.token_jaccard, "numbers"), "state_agree": two(S.equal, "state"), "postal_agree": two(S.equal, "postal"),
        "landmark_jacc": S.token_jaccard(S.landmarks(l("addr_norm")), S.landmarks(r("addr_norm"))),
        "addr_missing": flag((l("addr_empty") == 1) | (r("addr_empty") == 1)), "cand_source": F.substring("cand_id", 2, 1).try_cast("double"),
    }
    return df.select(*pairs.columns, *[c.alias(n) for n, c in features.items()])


FEATURES = (
    "name_key_eq name_compact_eq name_ratio name_token_sort name_token_set name_partial name_jw name_tok_jacc name_3gram_jacc "
    "name_compact_ratio name_len_ratio name_ntok_ratio legal_agree cand_is_domain script_diff cand_non_latin addr_key_eq addr_ratio "
    "addr_token_set addr_token_sort addr_tok_jacc addr_len_ratio house_eq house_suffix house_sim numbers_jacc state_agree postal_agree "
    "landmark_jacc addr_missing cand_source"
).split()
CONTEXT = "n_cands name_token_set_rank name_token_set_gap addr_token_set_rank addr_token_set_gap cand_n_s1 cand_rank_for_target".split()


def context_features(df: DataFrame, scores: tuple[str, ...] = ("name_token_set", "addr_token_set")) -> DataFrame:
    """Ranks and gaps of scores among an S1's candidates and a candidate's S1s.

    A missing score ranks as -1, and counts as 0 in the mean that ranks a candidate's
    S1s.  Windows per S1 hold the blocker's cap at most; a target has as many S1s as
    the rules' guards let through.
    """
    by_s1, by_cand = Window.partitionBy("s1_id"), Window.partitionBy("cand_id")
    out = df.withColumn("n_cands", F.count("*").over(by_s1).cast("double"))
    for c in scores:
        s = F.coalesce(F.col(c), F.lit(-1.0))
        out = out.withColumn("_s", s)
        out = out.withColumn(f"{c}_rank", F.rank().over(by_s1.orderBy(F.desc("_s"))).cast("double"))
        out = out.withColumn(f"{c}_gap", F.max("_s").over(by_s1) - F.col("_s")).drop("_s")
    out = out.withColumn("_q", sum(F.coalesce(F.col(c), F.lit(0.0)) for c in scores) / len(scores))
    out = out.withColumn("cand_n_s1", F.count("*").over(by_cand).cast("double"))
    return out.withColumn("cand_rank_for_target", F.rank().over(by_cand.orderBy(F.desc("_q"))).cast("double")).drop("_q")


def older_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """The older extractor's 12 features, from raw records; 0 rather than null for missing sides."""
    cleaned = records.select(
        "entity_id", clean_name(F.col("business_name")).alias("n"), clean_address(F.col("business_address")).alias("a"),
        F.upper(F.trim(text(F.col("country")))).alias("c"), postal_code(F.col("business_address"), F.col("country")).alias("p"),
    )
    df = sided(pairs, cleaned, ["n", "a", "c", "p"])
    df = df.withColumn("_f", similarities([("n", "ratio"), ("a", "ratio")], {x: (F.col(f"l_{x}"), F.col(f"r_{x}")) for x in "na"}))
    both = F.col("l_p").isNotNull() & F.col("r_p").isNotNull()
    out: dict[str, Column] = {"same_country": (F.col("l_c") != "") & (F.col("l_c") == F.col("r_c"))}
    for name, x in (("name", "n"), ("addr", "a")):
        a, b = F.col(f"l_{x}"), F.col(f"r_{x}")
        out[f"{name}_exact"] = (a != "") & (a == b)
        out[f"{name}_jaccard"] = S.plain_token_jaccard(a, b)
        out[f"{name}_ngram_jaccard"] = S.plain_gram_jaccard(a, b)
        out[f"{name}_ratio"] = F.when(a == b, 1.0).otherwise(F.coalesce(F.col(f"_f.{x}_ratio"), F.lit(0.0)))
        if x == "n":
            out["name_len_diff"] = F.abs(F.length(a) - F.length(b))
    out["postal_match"] = F.coalesce(both & (F.col("l_p") == F.col("r_p")), F.lit(False))
    out["postal_mismatch"] = F.coalesce(both & (F.col("l_p") != F.col("r_p")), F.lit(False))
    return df.select(*pairs.columns, *[c.cast("double").alias(n) for n, c in out.items()])


def older_matches(features: DataFrame) -> DataFrame:
    """Pairs that the older rule accepts."""
    name = F.greatest("name_ratio", "name_jaccard") >= 0.85
    return features.filter((F.col("same_country") == 1) & name & ((F.greatest("addr_ratio", "addr_jaccard") >= 0.5) | (F.col("postal_match") == 1)))
