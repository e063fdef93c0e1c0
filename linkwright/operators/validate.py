"""Checks of result files: findings as rows (rule, offenders, examples)."""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.sources.records import match_targets, read_ids, source_path
from linkwright.sources.results import CANDIDATES, MATCHES, parse_results

SHOWN = 5
RULES = (
    "duplicate_row", "repeated_id", "self_match", "wrong_prefix", "unknown_id", "missing_s1", "extra_s1", "malformed_row",
)


def with_ids(rows: DataFrame) -> DataFrame:
    """Parsed rows with their list of ids as it stands (not trimmed), empty for a blank list."""
    ids = F.when(F.trim("rest") != "", F.split("rest", ",")).otherwise(F.array().cast("array<string>"))
    return rows.filter("rest IS NOT NULL").withColumn("ids", ids)


def offenders(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule, offender): every offending id once per rule; rows as ``parse_results`` gives, ids as (id).

    ``known`` are the ids that may be matched; without it, unknown ids aren't looked for.
    """
    lists = with_ids(rows)
    s1 = lists.select(F.col("s1").alias("id"))
    each = lists.select(F.explode("ids").alias("id")).distinct()
    target = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    place = [F.lit("line "), (F.col("line") + 1).cast("string"), *([F.lit(" of "), F.substring_index("file", "/", -1)] if "file" in rows.columns else [])]
    found = [
        ("duplicate_row", s1.groupBy("id").agg(F.count("*").alias("_n")).filter("_n > 1")),
        ("repeated_id", lists.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.col("s1").alias("id"))),
        ("self_match", each.filter(F.col("id").startswith("S1-"))),
        ("wrong_prefix", each.filter(~F.col("id").startswith("S1-") & ~target)),
        ("missing_s1", required.select("id").join(s1, "id", "left_anti")),
        ("extra_s1", s1.join(required.select("id"), "id", "left_anti")),
        ("malformed_row", rows.filter("rest IS NULL AND trim(s1) <> ''").select(F.concat(*place).alias("id"))),
    ]
    if known is not None:
        found.append(("unknown_id", each.filter(target).join(known.select("id"), "id", "left_anti")))
    parts = [df.select(F.lit(rule).alias("rule"), F.col("id").alias("offender")) for rule, df in found]
    return reduce(DataFrame.unionByName, parts).distinct()


def findings(offending: DataFrame) -> DataFrame:
    """(rule, n, examples): the number of offenders of each broken rule, and the first five."""
    from pyspark.sql import Window

    first = offending.withColumn("_r", F.row_number().over(Window.partitionBy("rule").orderBy("offender"))).filter(F.col("_r") <= SHOWN)
    shown = first.groupBy("rule").agg(F.array_join(F.sort_array(F.collect_list("offender")), ", ").alias("examples"))
    return offending.groupBy("rule").agg(F.count("*").alias("n")).join(shown, "rule")


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1): S1s with a match that isn't among their candidates."""
    pairs = lambda df: with_ids(df).select("s1", F.explode("ids").alias("id")).distinct()
    return pairs(matches).join(pairs(candidates), ["s1", "id"], "left_anti").select("s1").distinct()


def validate(spark, matches: str, candidates: str | None, required: DataFrame, known: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a match file and an optional candidate file."""
    errors, warnings = [], []
    if known is None:
        warnings.append("it isn't checked whether matched ids exist")
    parsed = {}
    for path, header in ((matches, MATCHES), (candidates, CANDIDATES)):
        if path is None:
            continue
        rows, fatal = parse_results(spark, path, header)
        if fatal and header == CANDIDATES and fatal[0].startswith("unreadable"):
            warnings.append(f"{path} isn't there: candidates aren't checked")
            continue
        errors += fatal
        if not fatal:
            parsed[header] = rows
            errors += [f"{path}: {r['rule']}: {r['n']}, such as {r['examples']}" for r in findings(offenders(rows, required, known)).orderBy("rule").collect()]
    if len(parsed) == 2:
        n = outside_candidates(parsed[MATCHES], parsed[CANDIDATES]).count()
        if n:
            warnings.append(f"{n} S1 records have matches that aren't among their candidates")
    return errors, warnings


def main(args: list[str] | None = None) -> int:
    """Check result files from a command line: prints errors and warnings; the exit code is 1 with errors, else 0."""
    p = argparse.ArgumentParser(description="check a match file and its candidate file")
    p.add_argument("matches")
    p.add_argument("--candidates")
    p.add_argument("--data", help="folder of the record files")
    p.add_argument("--split", default="test")
    p.add_argument("--ids", action="store_true", help="check also that matched ids exist")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    required = read_ids(spark, source_path(a.data or "data", a.split, 1))
    known = match_targets(spark, a.data or "data", a.split) if a.ids else None
    errors, warnings = validate(spark, a.matches, a.candidates, required, known)
    print("\n".join([*[f"error: {x}" for x in errors], *[f"warning: {x}" for x in warnings], "FAIL" if errors else "OK"]))
    return int(bool(errors))


if __name__ == "__main__":
    raise SystemExit(main())
