"""From scored pairs (s1_id, cand_id, p) and rule pairs to each S1's matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VARIANTS = ("all", "addr_first", "addr_only")


def variant(pairs: DataFrame, name: str) -> DataFrame:
    """Baseline pairs: all, address pairs alone, or those where an S1 has one and all pairs elsewhere."""
    if name == "all":
        return pairs
    if name == "addr_only":
        return pairs.filter("R3 = 1")
    if name == "addr_first":
        some = F.max("R3").over(Window.partitionBy("s1_id"))
        return pairs.withColumn("_some", some).filter("R3 = 1 OR _some = 0").drop("_some")
    raise ValueError(f"no such variant: {name!r}")


def one_owner_by_rules(pairs: DataFrame) -> DataFrame:
    """Each target stays with the S1 of most rules; a target with several such S1s is dropped.

    One aggregate per target (best count and how many have it) in place of windows,
    so that a hot target is combined map-side.
    """
    counts = pairs.groupBy("cand_id", "n_rules").agg(F.count("*").alias("_c"))
    best = counts.groupBy("cand_id").agg(F.max(F.struct("n_rules", "_c")).alias("_b")).filter("_b._c = 1")
    return pairs.join(best.select("cand_id", F.col("_b.n_rules").alias("n_rules")), ["cand_id", "n_rules"], "left_semi").select(*pairs.columns)


def one_owner(scored: DataFrame) -> DataFrame:
    """Each target stays with the S1 of highest p; ties go to the first S1 by id."""
    best = scored.groupBy("cand_id").agg(F.min(F.struct((-F.col("p")).alias("m"), F.col("s1_id"))).alias("_b"))
    return scored.join(best.select("cand_id", F.col("_b.s1_id").alias("s1_id")), ["cand_id", "s1_id"], "left_semi").select(*scored.columns)


def threshold(scored: DataFrame, t: float) -> DataFrame:
    return scored.filter(F.col("p") >= t)


def expected_f(scored: DataFrame, c: float = 0.0, r: float = 1.0) -> DataFrame:
    """Per S1, the first candidates by p whose expected F0.5 is highest, if it beats predicting none.

    E(k) = 1.25 * sum of the first k p / (0.25 * (sum of all p + c) + k); predicting
    none is worth r times the chance that no candidate matches.  The first k of the
    highest E is taken.
    """
    group = Window.partitionBy("s1_id")
    order = group.orderBy(F.desc("p"), "cand_id")
    df = scored.withColumn("_k", F.row_number().over(order))
    df = df.withColumn("_sum", F.sum("p").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("_e", 1.25 * F.col("_sum") / (0.25 * (F.sum("p").over(group) + c) + F.col("_k")))
    df = df.withColumn("_none", r * F.exp(F.sum(F.log1p(-F.least("p", F.lit(1 - 1e-6)))).over(group)))
    df = df.withColumn("_best", F.max(F.struct("_e", (-F.col("_k")).alias("k"))).over(group))
    return df.filter((F.col("_k") <= -F.col("_best.k")) & (F.col("_best._e") > F.col("_none"))).select(*scored.columns)


def decide(scored: DataFrame, decision: dict) -> DataFrame:
    """One owner per target, then {"method": "threshold", "t": ...} or {"method": "expected_f", "c": ..., "r": ...}."""
    params = {k: v for k, v in decision.items() if k != "method"}
    methods = {"threshold": threshold, "expected_f": expected_f}
    if decision.get("method") not in methods:
        raise ValueError(f"no such decision method: {decision.get('method')!r}")
    return methods[decision["method"]](one_owner(scored), **params)
