"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.plans.staging import settled

#: A word is a run of characters other than the six ASCII white-space ones.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Heaps up to so many bytes are small: collecting all their garbage takes a tenth of a second.
SMALL_HEAP = 2 << 30


def tidy(spark: SparkSession) -> None:
    """Let a driver with little free memory drop what finished steps have left.

    Broadcast tables and shuffle files go when their plans are collected.  A small
    table takes megabytes as a broadcast, so many short steps would fill a small
    driver before its collector gets to them.  Bursts of large arrays make a heap
    grow far beyond what it holds; a collection gives that back to the system.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    most, taken = heap.maxMemory(), heap.totalMemory()
    if taken - heap.freeMemory() > 0.3 * most or (most <= SMALL_HEAP and taken > 0.6 * most):
        spark._jvm.java.lang.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder and drop its lineage."""
    tidy(df.sparkSession)
    return settled(df)


def width(spark: SparkSession) -> int:
    """Partitions that the session wants after a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale and script."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words of a text as an array; none for null or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, so that extra columns can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def prefix_totals(df: DataFrame, order: list[str], sums: dict[str, str], parts: int | None = None) -> DataFrame:
    """Exclusive global prefix sums of columns in the order of ``order``.

    Rows are dealt by range and frozen by a checkpoint, so that the partition of
    each row can't change; a total per partition, its running sum over the
    partitions and a running sum inside each partition make up the prefix.
    ``sums`` maps new column names to the summed expressions.  Ties of the whole
    order are broken by the row's place in the input, so that repeated rows are
    spread as well.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    parts = parts or width(spark)
    order = [*order, "_row"]
    dealt = (
        df.withColumn("_row", F.monotonically_increasing_id())
        .withColumns({f"_w_{k}": F.expr(v).cast("long") for k, v in sums.items()})
        .repartitionByRange(parts, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    dealt = cut(dealt)
    totals = dealt.groupBy("_part").agg(*[F.sum(f"_w_{k}").alias(f"_t_{k}") for k in sums])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_b_{k}") for k in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(F.broadcast(totals), "_part")  # as many rows as partitions
    out = out.withColumns({k: F.col(f"_b_{k}") + F.coalesce(F.sum(f"_w_{k}").over(inside), F.lit(0)) for k in sums})
    return out.drop("_part", "_row", *[f"_{x}_{k}" for k in sums for x in "wb"])


#: Tables of ids of up to so many rows are broadcast, larger ones are joined by shuffle.
#: The driver holds a broadcast's rows, their hashed table and its blocks at once: 116 bytes an id for the table alone.
BROADCAST_IDS = 50_000


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, bad: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't in ``bad``, with all their columns, whatever these are called.

    Null ids match null ids; rows of one id stay or go together.  Beyond ``limit``
    ids the rows are shuffled with their texts.
    """
    gone = free_name(docs, "_bad")
    bad = cut(bad.select(F.col("doc_id").alias(gone)).distinct())
    bad = F.broadcast(bad) if bad.count() <= limit else bad.hint("merge")  # else Spark may still broadcast them
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti")


class Sent:
    """A value broadcast to the executors with the code of its classes."""

    def __init__(self, spark: SparkSession, value: object):
        from pyspark import cloudpickle

        self.pickled = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> object:
        import pickle

        return pickle.loads(self.pickled.value)
