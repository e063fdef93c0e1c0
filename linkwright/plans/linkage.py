"""Whole linkage runs, composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.operators import blocking, decision, features, metrics, reports
from linkwright.operators.matcher import Matcher
from linkwright.operators.normalize import normalize
from linkwright.sources.results import candidate_lists, match_lists


def split_sources(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 records and targets, told apart by their ids' prefix."""
    s1 = F.col("entity_id").startswith("S1-")
    return records.filter(s1), records.filter(~s1)


def s1_ids(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("s1_id")).distinct()


def block(records: DataFrame, rules: tuple[blocking.Rule, ...] = blocking.RULES, most: int | None = blocking.MAX_CANDIDATES) -> DataFrame:
    """Capped candidates of raw records."""
    s1, targets = split_sources(normalize(records))
    return blocking.candidates(s1, targets, rules, most)


def featured(candidates: DataFrame, records: DataFrame, context: bool = True) -> DataFrame:
    """Candidates with all features; context features only make sense over all candidates."""
    out = features.pair_features(candidates.select("s1_id", "cand_id"), records)
    return features.context_features(out) if context else out


def baseline(records: DataFrame, truth: DataFrame | None = None, variant: str | None = None) -> tuple[DataFrame, str]:
    """Matches by the three exact rules, and the variant used: the given one or the one of best macro F0.5."""
    s1, targets = split_sources(normalize(records))
    pairs = blocking.baseline_pairs(s1, targets)
    if variant is None:
        if truth is None:
            raise ValueError("without a variant, the truth is needed to choose one")
        ids, scored = s1_ids(s1), []
        for v in decision.VARIANTS:
            got = decision.one_owner_by_rules(decision.variant(pairs, v))
            scored.append((metrics.macro(metrics.entity_scores(got, truth, ids)).first()["macro_f05"], v))
        variant = max(scored, key=lambda x: x[0])[1]
    return decision.one_owner_by_rules(decision.variant(pairs, variant)), variant


def learned(records: DataFrame, matcher: Matcher, settings: dict) -> DataFrame:
    """Matches of raw records by a fitted matcher and a decision."""
    norm = normalize(records)
    s1, targets = split_sources(norm)
    rows = featured(blocking.candidates(s1, targets), norm)
    return decision.decide(matcher.score(rows).select("s1_id", "cand_id", "p"), settings)


def older(records: DataFrame) -> DataFrame:
    """Matches of raw records by the older features and rule, over today's candidates."""
    found = block(records, most=30).select("s1_id", "cand_id")
    return features.older_matches(features.older_features(found, records))


def recall_report(candidates: DataFrame, truth: DataFrame, s1: DataFrame) -> dict:
    """Recall and pool sizes of candidates as plain numbers."""
    return {**metrics.recall(candidates, truth).first().asDict(), **metrics.pool_statistics(candidates, s1).first().asDict()}


def result_tables(s1: DataFrame, matches: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two result tables, a row per S1."""
    return match_lists(s1, matches), candidate_lists(s1, candidates)


__all__ = ["baseline", "block", "featured", "learned", "older", "recall_report", "reports", "result_tables", "s1_ids", "split_sources"]
