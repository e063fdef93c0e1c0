"""Command lines: candidates, the baseline and scores of result files."""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from linkwright.operators import blocking, decision, metrics
from linkwright.operators.normalize import normalize
from linkwright.plans import linkage
from linkwright.plans.staging import settled
from linkwright.sources import records, results

MARKER = "baseline_variant"


def normalized(spark: SparkSession, data: str, split: str, work: str) -> DataFrame:
    """The split's normal forms, made once and kept in the work folder."""
    path = f"{work}/norm_{split}"
    if not results.written(spark, path):
        raw = reduce(DataFrame.unionByName, [records.read_source(spark, data, split, i) for i in records.SOURCES])
        results.write_once(normalize(raw), path)
    return spark.read.parquet(path)


def candidates(spark: SparkSession, data: str, split: str, work: str, most: int = blocking.MAX_CANDIDATES, out: str | None = None, force: bool = False) -> str:
    """Capped candidates of a split as parquet, made once, and as a result file where ``out`` is given; the parquet's path."""
    s1, targets = linkage.split_sources(normalized(spark, data, split, work))
    path = f"{work}/candidates_{split}"
    results.write_once(blocking.candidates(s1, targets, most=most), path, force)
    if out:
        results.write_tsv(results.candidate_lists(linkage.s1_ids(s1), spark.read.parquet(path)), out)
    return path


def baseline(spark: SparkSession, data: str, work: str, stages: tuple[str, ...] = ("pairs", "score", "write"), out: str = "out") -> str | None:
    """The stages of the baseline; each reads what those before it have written.

    ``pairs`` writes both splits' pairs, ``score`` the variant of best macro F0.5 on
    the train split and its scores, ``write`` the test split's two result files.
    """
    if "pairs" in stages:
        for split in records.SPLITS:
            s1, targets = linkage.split_sources(normalized(spark, data, split, work))
            results.write_once(blocking.baseline_pairs(s1, targets), f"{work}/pairs_{split}")
    if "score" in stages:
        s1 = linkage.s1_ids(linkage.split_sources(normalized(spark, data, "train", work))[0])
        truth = records.truth_pairs(records.read_truth(spark, f"{data}/train_ground_truth.tsv")).withColumnRenamed("match_id", "cand_id")
        pairs, best = spark.read.parquet(f"{work}/pairs_train"), None
        for v in decision.VARIANTS:
            scores = settled(metrics.entity_scores(decision.one_owner_by_rules(decision.variant(pairs, v)), truth, s1))
            f = metrics.macro(scores).first()["macro_f05"]
            if best is None or f > best[0]:
                best = f, v, scores
        results.write_parquet(best[2].select("s1_id", "n_true", "n_pred", "f05"), f"{work}/baseline_scores")
        results.write_marker(spark, f"{work}/{MARKER}", best[1])
    if "write" in stages:
        variant = results.read_marker(spark, f"{work}/{MARKER}")
        s1 = linkage.s1_ids(linkage.split_sources(normalized(spark, data, "test", work))[0])
        pairs = spark.read.parquet(f"{work}/pairs_test")
        results.write_tsv(results.match_lists(s1, decision.one_owner_by_rules(decision.variant(pairs, variant))), f"{out}/matches")
        results.write_tsv(results.match_lists(s1, pairs, results.CANDIDATES[1]), f"{out}/candidates")
        return variant
    return None


def report(spark: SparkSession, data: str, predicted: str, ids: str | None = None) -> str:
    """The text report of a match file on the train split, for all S1s or those of an id list."""
    s1 = records.read_source(spark, data, "train", 1, ["entity_id", "country"]).withColumnRenamed("entity_id", "s1_id")
    chosen = records.read_ids(spark, ids).withColumnRenamed("id", "s1_id") if ids else s1.select("s1_id")
    truth, found = (records.truth_pairs(records.read_truth(spark, p)).withColumnRenamed("match_id", "cand_id") for p in (f"{data}/train_ground_truth.tsv", predicted))
    return metrics.score_report(metrics.entity_scores(found, truth, chosen), s1)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="record linkage from the command line")
    p.add_argument("--data", default="data", help="folder of the record files")
    p.add_argument("--work", default="work", help="folder of intermediate tables")
    sub = p.add_subparsers(dest="what", required=True)
    c = sub.add_parser("candidates")
    c.add_argument("--split", choices=records.SPLITS, default="test")
    c.add_argument("--max-candidates", type=int, default=blocking.MAX_CANDIDATES)
    c.add_argument("--output")
    b = sub.add_parser("baseline")
    b.add_argument("--stage", choices=("pairs", "score", "write", "all"), default="all")
    b.add_argument("--output", default="out")
    r = sub.add_parser("report")
    r.add_argument("predicted")
    r.add_argument("--ids")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if a.what == "candidates":
        print(candidates(spark, a.data, a.split, a.work, a.max_candidates, a.output))
    elif a.what == "baseline":
        print(baseline(spark, a.data, a.work, ("pairs", "score", "write") if a.stage == "all" else (a.stage,), a.output))
    else:
        print(report(spark, a.data, a.predicted, a.ids))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
