"""Candidate pairs from equal keys, with a guard against crowded keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions import wordlists as L
from linkwright.functions.text import blocking_tokens, both, name_stem, street_word, text


@dataclass(frozen=True)
class Rule:
    """A key column and its guard: rows of a key on either side at most, key length at least."""

    name: str
    key: str
    max_s1: int
    max_target: int
    min_length: int = 0
    priority: int = 1


RULES = (
    Rule("R1", "name_key", 20, 50, 0, 1), Rule("R2", "name_compact", 20, 50, 0, 1), Rule("R3", "addr_key", 20, 50, 0, 1),
    Rule("R4", "name_stem", 20, 50, 4, 1), Rule("R5", "house_w1", 20, 50, 4, 2), Rule("R6", "house_p3", 20, 50, 4, 2),
    Rule("R7", "house_p2", 15, 30, 3, 2), Rule("R8", "house_street", 15, 30, 4, 2), Rule("R9", "w1_w2", 15, 35, 5, 2),
    Rule("R10", "state_w1", 15, 40, 4, 3), Rule("R11", "house_w2", 15, 30, 4, 3), Rule("R12", "w1", 15, 30, 3, 3),
    Rule("R13", "house_state", 10, 20, 4, 4),
)
RULES_7 = (
    Rule("R1", "name_key", 20, 50, 0, 1), Rule("R2", "name_compact", 20, 50, 0, 1), Rule("R3", "addr_key", 20, 50, 0, 1),
    Rule("R4", "w1", 15, 30, 3, 2), Rule("R5", "house_p3", 20, 50, 4, 2), Rule("R6", "state_w1", 15, 40, 4, 3), Rule("R7", "w2", 10, 25, 3, 3),
)
BASELINE = tuple(Rule(n, k, 3, 40) for n, k in (("R1", "name_key"), ("R2", "name_compact"), ("R3", "addr_key")))
MAX_CANDIDATES = 50
KEY = ["country", "rule", "key"]


def with_keys(records: DataFrame, stop_words: list[str] = L.STOP_WORDS) -> DataFrame:
    """Normalised records with all columns that rules use as keys."""
    df = records.withColumns(blocking_tokens(F.col("name_core"), stop_words))
    df = df.withColumns({"name_stem": name_stem(F.col("name_core")), "street_w1": street_word(F.col("addr_norm")), "p2": F.substring("name_norm", 1, 2)})
    house, state = F.col("house_no"), F.col("state")
    pairs = {f"house_{c}": both(house, F.col(c)) for c in ("p3", "p2", "w1", "w2")}
    pairs |= {"house_street": both(house, F.col("street_w1")), "house_state": both(house, state), "state_w1": both(state, F.col("w1")), "w1_w2": both(F.col("w1"), F.col("w2"))}
    return df.withColumns(pairs)


def key_rows(records: DataFrame, rules: tuple[Rule, ...], drop_none: bool = True) -> DataFrame:
    """(entity_id, country, rule, key): a row per record and rule whose key can join."""
    entries = [F.struct(F.lit(i).alias("rule"), text(F.col(r.key)).alias("key"), F.lit(r.min_length).alias("least")) for i, r in enumerate(rules)]
    rows = records.select("entity_id", "country", F.explode(F.array(*entries)).alias("e")).select("entity_id", "country", "e.*")
    fits = (F.col("key") != "") & (F.length("key") >= F.col("least"))
    return rows.filter(fits & (F.col("key") != "None") if drop_none else fits).drop("least")


def of_rule(rules: tuple[Rule, ...], field: str) -> Column:
    """A rule's field by the column ``rule``."""
    return F.get(F.array(*[F.lit(getattr(r, field)) for r in rules]), F.col("rule"))


def open_keys(s1: DataFrame, targets: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Keys with rows on both sides and no more than the guard allows, counted over the whole tables.

    Counts are summed map-side: a crowded key shuffles a row per task.
    """
    each = s1.select(*KEY, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(targets.select(*KEY, F.lit(0).alias("a"), F.lit(1).alias("b")))
    counts = each.groupBy(*KEY).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return counts.filter((F.col("a") >= 1) & (F.col("b") >= 1) & (F.col("a") <= of_rule(rules, "max_s1")) & (F.col("b") <= of_rule(rules, "max_target"))).select(*KEY)


def rule_pairs(s1: DataFrame, targets: DataFrame, rules: tuple[Rule, ...] = RULES, drop_none: bool = True) -> DataFrame:
    """(s1_id, cand_id, rule): pairs of equal country and key under every rule, in one join.

    Crowded keys are removed from both sides before the pairs are made, so a join of
    open keys alone is shuffled, and its output is bounded by the guard: at most
    max_s1 * max_target pairs of a key.
    """
    a, b = key_rows(s1, rules, drop_none), key_rows(targets, rules, drop_none)
    keys = open_keys(a, b, rules)
    a = a.join(keys, KEY, "left_semi").withColumnRenamed("entity_id", "s1_id")
    b = b.join(keys, KEY, "left_semi").withColumnRenamed("entity_id", "cand_id")
    return a.join(b, KEY).select("s1_id", "cand_id", "rule")


def combined(pairs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(s1_id, cand_id, n_rules, best_priority, first_rule): a row per distinct pair."""
    return pairs.groupBy("s1_id", "cand_id").agg(
        F.count("*").alias("n_rules"), F.min(of_rule(rules, "priority")).alias("best_priority"), F.min("rule").alias("first_rule")
    )


def ranked(candidates: DataFrame, most: int | None = MAX_CANDIDATES) -> DataFrame:
    """Candidates with a 0-based rank per S1, of which those below ``most`` stay.

    Best priority first, then most rules; ties by the first rule and the candidate's id.
    """
    w = Window.partitionBy("s1_id").orderBy("best_priority", F.desc("n_rules"), "first_rule", "cand_id")
    out = candidates.withColumn("rank", F.row_number().over(w))
    if most is not None:
        out = out.filter(F.col("rank") <= most)
    return out.withColumn("rank", F.col("rank") - 1)


def candidates(s1: DataFrame, targets: DataFrame, rules: tuple[Rule, ...] = RULES, most: int | None = MAX_CANDIDATES) -> DataFrame:
    """The capped candidates of every S1 record under all rules."""
    return ranked(combined(rule_pairs(with_keys(s1), with_keys(targets), rules), rules), most)


def baseline_pairs(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1_id, cand_id, R1, R2, R3, n_rules) under the three strict rules."""
    pairs = rule_pairs(s1, targets, BASELINE, drop_none=False)
    out = pairs.groupBy("s1_id", "cand_id").agg(*[F.max((F.col("rule") == i).cast("int")).alias(r.name) for i, r in enumerate(BASELINE)])
    return out.withColumn("n_rules", F.col("R1") + F.col("R2") + F.col("R3"))
