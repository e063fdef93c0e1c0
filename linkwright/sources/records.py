"""Reading records, truth and id lists."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkwright.functions.text import id_list, text

COLUMNS = ("entity_id", "business_name", "business_address", "country")
SPLITS, SOURCES = ("train", "test"), (1, 2, 3)


def data_dir(default: str = "data") -> str:
    """The folder of the record files: ``LINK_DATA_DIR`` or the first of the usual places that exists."""
    found = [d for d in (os.environ.get("LINK_DATA_DIR"), default, f"../{default}") if d]
    return next((d for d in found if os.path.isdir(d)), found[0])


def source_path(folder: str, split: str, source: int) -> str:
    if split not in SPLITS or source not in SOURCES:
        raise ValueError(f"no such source: {split!r}, {source!r}")
    return f"{folder}/{split}_source{source}.tsv"


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A tab-separated file with a header, all columns text, nothing quoted, empty for missing.

    Names are read from the header; ``NA``, ``nan`` and stray quotes are kept.
    """
    df = spark.read.options(sep="\t", header=True, quote="", encoding="UTF-8", inferSchema=False).csv(path)
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*[text(F.col(f"`{c}`")).alias(c) for c in columns or df.columns])


def read_source(spark: SparkSession, folder: str, split: str, source: int, columns: list[str] | None = None, rows: int | None = None) -> DataFrame:
    df = read_tsv(spark, source_path(folder, split, source), list(columns or COLUMNS))
    return df if rows is None else df.limit(rows)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, ["source1_entity_id", "matched_entity_ids"])


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, match_id): a row per id of each list; empty entries are dropped, then blanks trimmed."""
    each = truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(F.split(text(F.col("matched_entity_ids")), ",")).alias("match_id"))
    return each.filter("match_id <> ''").withColumn("match_id", F.trim("match_id"))


def truth_sets(truth: DataFrame, ids: str = "matched_entity_ids") -> DataFrame:
    """(s1_id, ids): a row per S1 with its set of ids, the empty one included."""
    return truth.select(F.trim("source1_entity_id").alias("s1_id"), F.array_distinct(id_list(F.col(ids))).alias("ids"))


def gather_records(records: DataFrame, ids: DataFrame, check: bool = True) -> DataFrame:
    """The records of some ids (entity_id), one each; an error if one is missing.

    The id list prunes the records by a semi join, for which the planner builds a
    broadcast or a runtime filter by its size.
    """
    found = records.join(ids.select("entity_id").distinct(), "entity_id", "left_semi").dropDuplicates(["entity_id"])
    if check:
        lost = ids.select("entity_id").distinct().join(records, "entity_id", "left_anti")
        names = [r[0] for r in lost.orderBy("entity_id").limit(5).collect()]
        if names:
            raise ValueError(f"ids without a record, such as {names}")
    return found


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of a text file or of a folder's files, numbered from 0 in each.

    Splits of a file are numbered on their own; a row per split, with the lines
    before it, makes the numbers run through.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    splits = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = splits.select("file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(splits, ["file", "_block"]).select("file", (F.col("_id") - F.col("_first") + F.col("_before")).alias("line"), "value")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id): the distinct first columns of a tab-separated file or of a folder's files, without their headers and blank lines."""
    rows = numbered_lines(spark, path).filter((F.col("line") > 0) & (F.trim("value") != ""))
    return rows.select(F.trim(F.substring_index("value", "\t", 1)).alias("id")).distinct()


def match_targets(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """(id): the ids of both target sources, which a result may name."""
    return read_ids(spark, source_path(folder, split, 2)).unionByName(read_ids(spark, source_path(folder, split, 3))).distinct()


def of_countries(records: DataFrame, countries: list[str]) -> DataFrame:
    """The records of some countries, whatever the case and the blanks around their names."""
    return records.filter(F.lower(F.trim(text(F.col("country")))).isin([c.strip().lower() for c in countries]))


def sample_per_group(df: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows of each group, those of least seeded hash of the key."""
    w = Window.partitionBy(group).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key)
    return df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n).drop("_k")
