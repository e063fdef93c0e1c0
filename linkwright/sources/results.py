"""Writing and parsing result files: an id and a comma-separated list of ids per row."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.sources.records import numbered_lines

MATCHES = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")
#: So many unlike headers of a folder's files are looked at: one that isn't as expected is a finding.
SHOWN_HEADS = 20
PLAIN = {"sep": "\t", "header": True, "quote": "", "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace a folder of parquet parts: the new one is written beside it and renamed when it is whole.

    Where a job fails, the old folder stands as it was.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, old = f"{path}.{uuid.uuid4().hex}", hadoop(path)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.option("compression", "zstd").parquet(new)
    except Exception:
        files.delete(hadoop(new), True)
        raise
    files.delete(old, True)
    if not files.rename(hadoop(new), old):
        raise OSError(f"{new} can't be renamed to {path}")


def written(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end, in any file system that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_once(df: DataFrame, path: str, force: bool = False) -> bool:
    """Write unless a finished folder is there; whether it was written."""
    if written(df.sparkSession, path) and not force:
        return False
    write_parquet(df, path)
    return True


def listed(order: Column, ids: Column) -> Column:
    """A comma-separated list of a group's ids in some order."""
    pairs = F.array_sort(F.collect_list(F.when(ids.isNotNull(), F.struct(order.alias("o"), ids.alias("id")))))
    return F.array_join(F.transform(pairs, lambda p: p["id"]), ",")


def match_lists(s1: DataFrame, pairs: DataFrame, name: str = MATCHES[1]) -> DataFrame:
    """A row per S1 (s1_id) with its ids (cand_id) in sorted order, empty without any."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("cand_id")), ",").alias(name))
    return s1.select("s1_id").distinct().join(lists, "s1_id", "left").select(F.col("s1_id").alias(MATCHES[0]), F.coalesce(name, F.lit("")).alias(name))


def candidate_lists(s1: DataFrame, ranked: DataFrame) -> DataFrame:
    """A row per S1 with its candidates (cand_id, rank) in the order of their rank."""
    name = CANDIDATES[1]
    lists = ranked.groupBy("s1_id").agg(listed(F.col("rank"), F.col("cand_id")).alias(name))
    return s1.select("s1_id").distinct().join(lists, "s1_id", "left").select(F.col("s1_id").alias(MATCHES[0]), F.coalesce(name, F.lit("")).alias(name))


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").options(**PLAIN).csv(path)


def write_json(report: dict | list, path: str) -> None:
    Path(path).write_text(json.dumps(report, indent=2, default=str))


def read_json(path: str) -> dict | list:
    return json.loads(Path(path).read_text())


def write_csv(df: DataFrame, path: str) -> None:
    """A report table as comma-separated files with a header."""
    df.write.mode("overwrite").options(header=True, sep=",", quoteAll=False, escape='"').csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated files with a header, all columns text."""
    return spark.read.options(header=True, sep=",", escape='"', multiLine=True).csv(path)


def write_marker(spark: SparkSession, path: str, value: str) -> None:
    """A line of text that a later stage reads."""
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_marker(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"].strip()


def parse_results(spark: SparkSession, path: str, expected: tuple[str, str]) -> tuple[DataFrame, list[str]]:
    """Rows (file, line, s1, rest) of a result file, or of a folder of them, and what makes it unreadable.

    Every file has a header: the expected names, in any case, between tabs.  Lines
    are numbered from 0, the header, in each file.  A row's ``rest`` is null where it
    has no tab.
    """
    none = spark.createDataFrame([], "file string, line long, s1 string, rest string")
    try:
        lines = numbered_lines(spark, path)
        heads = [r["value"] for r in lines.filter("line = 0").groupBy("value").count().orderBy(F.desc("count"), "value").limit(SHOWN_HEADS).collect()]
    except Exception as e:  # a missing or unreadable file is a finding
        return none, [f"unreadable: {path}: {str(e).splitlines()[0]}"]
    if not heads:
        return none, [f"{path} is empty"]
    for head in heads:
        if "\t" not in head and "," in head:
            return none, [f"{path} is comma-separated, not tab-separated"]
        if [c.strip().lower() for c in head.split("\t")] != list(expected):
            return none, [f"{path}: the header is {head!r}, not {list(expected)}"]
    return lines.filter(F.col("line") > 0).select(
        "file", "line", F.substring_index("value", "\t", 1).alias("s1"),
        F.when(F.instr("value", "\t") > 0, F.expr("substring(value, instr(value, '\t') + 1)")).alias("rest"),
    ), []
