"""Samples, folds and look-alike pairs, by hashes in place of random numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions.text import text


def drawn(key: str, seed: int) -> Column:
    """The md5 of the seed and the key: the same order in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def exact_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows: those of least seeded hash of the key."""
    return df.orderBy(drawn(key, seed), key).limit(n)


def folds(s1: DataFrame, k: int = 5, seed: int = 42, key: str = "s1_id") -> DataFrame:
    """(key, fold): balanced folds, one apart in size at most.

    Rows are numbered in the order of their hashes, modulo ``k``.  They are dealt to
    4,096 buckets by the first three digits of the hash and numbered in their bucket;
    bucket totals, 4,096 rows at most, give each bucket's offset, so no task orders
    all rows.
    """
    rows = s1.select(key).distinct().withColumn("_h", drawn(key, seed)).withColumn("_b", F.substring("_h", 1, 3))
    sizes = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1
    return rows.withColumn("_r", inside).join(F.broadcast(sizes), "_b").select(key, F.pmod(F.col("_o") + F.col("_r"), F.lit(k)).cast("int").alias("fold"))


def regrouped(folded: DataFrame, k: int) -> DataFrame:
    return folded.withColumn("fold", F.pmod("fold", F.lit(k)))


def look_alike_keys(records: DataFrame) -> DataFrame:
    """Records with nkey (country and first key token) and akey (country, house and state), empty if incomplete."""
    first = F.substring_index(text(F.col("name_key")), " ", 1)
    house = (F.col("house_no") != "") & (F.col("state") != "")
    return records.withColumn("nkey", F.when(first != "", F.concat_ws("|", "country", first)).otherwise("")).withColumn(
        "akey", F.when(house, F.concat_ws("|", "country", "house_no", "state")).otherwise("")
    )


def look_alikes(s1: DataFrame, targets: DataFrame, truth: DataFrame, per_key: int = 8, per_s1: int = 8, seed: int = 42) -> DataFrame:
    """(s1_id, cand_id, label): all true pairs, and up to ``per_s1`` false ones per S1 that share a key.

    Each key offers ``per_key`` targets at most, chosen by hash (this is the sampling
    operator's own limit).
    """
    s1, targets = look_alike_keys(s1), look_alike_keys(targets)
    found = None
    for k in ("nkey", "akey"):
        a = s1.filter(F.col(k) != "").select(F.col("entity_id").alias("s1_id"), k)
        b = targets.filter(F.col(k) != "").select(F.col("entity_id").alias("cand_id"), k)
        w = Window.partitionBy(k).orderBy(drawn("cand_id", seed), "cand_id")
        b = b.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_key).drop("_r")
        m = a.join(b, k).select("s1_id", "cand_id")
        found = m if found is None else found.unionByName(m)
    true = truth.select("s1_id", "cand_id").distinct()
    false = found.distinct().join(true, ["s1_id", "cand_id"], "left_anti")
    w = Window.partitionBy("s1_id").orderBy(drawn("cand_id", seed), "cand_id")
    false = false.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_s1).drop("_r")
    return true.withColumn("label", F.lit(1)).unionByName(false.withColumn("label", F.lit(0)))
