"""Quality rules with thresholds that adapt to language and source (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkwright.llm.common import cut, only, table
from linkwright.llm.text_stats import COUNTS_SQL, with_counts

MIN_WORDS = 50
#: A language and source need so many rows for thresholds of their own.
MIN_GROUP = 200
#: Quantiles of the sketch, in percent, and the fence: beyond them by so many times their distance.
LOW, HIGH, REACH = 25, 75, 3
#: metric -> (expression over the counts, least distance from the quartile, whether low values fail too)
METRICS = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 20, False),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 150, False),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 250, False),
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 80, True),
}
#: Sketch values keep so many leading bits: quantiles are right to one part in 32.
BITS = 6


def sketched(value: Column) -> Column:
    """The bin of a value: the value with all but its leading bits cleared."""
    low = F.greatest(F.length(F.bin(value)) - F.lit(BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def quantile_sketch(rows: DataFrame, groups: list[str], metrics: list[str]) -> DataFrame:
    """Counts per group, metric and bin.

    Sketches merge by adding counts, so map-side aggregation keeps a hot group
    small: a group has at most 32 bins per power of two of a metric's range.
    """
    each = rows.select(
        *groups, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), sketched(F.col(f"m_{m}")).alias("bin")) for m in metrics])).alias("_s")
    )
    return each.groupBy(*groups, "_s.metric", "_s.bin").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Quartiles and fences per group and metric, read from a sketch."""
    part = [*groups, "metric"]
    sketch = sketch.groupBy(*part, "bin").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(*part).orderBy("bin")  # bins of one group and metric: bounded
    seen = sketch.withColumn("_seen", F.sum("n").over(running)).withColumn("_all", F.sum("n").over(Window.partitionBy(*part)))
    at = lambda q: F.min(F.when(F.col("_seen") * 100 >= F.col("_all") * q, F.col("bin")))
    found = seen.groupBy(*part).agg(at(LOW).alias("q_low"), at(HIGH).alias("q_high"), F.max("_all").alias("rows"))
    slack = F.create_map(*[F.lit(x) for m, (_, s, _) in METRICS.items() for x in (m, s)])[F.col("metric")]
    reach = F.greatest(slack, REACH * (F.col("q_high") - F.col("q_low")))
    return found.withColumn("low", F.col("q_low") - reach).withColumn("high", F.col("q_high") + reach)


def rule_verdicts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Base counts and verdict of every document.

    ``base_failed`` is the fixed rule.  All other rows get a verdict by thresholds
    that adapt: mergeable quantile sketches per language and source give quartiles
    of four shares, and a document fails where a share lies beyond the quartiles by
    more than three times their distance (a least distance per metric applies).  A
    group of fewer than ``min_group`` rows takes its language's thresholds, and a
    small language those of the whole table.  Sketches cover every text with a word.

    Null or blank texts have zero counts and fail the base rule; null languages and
    sources are groups like any other; repeated rows are judged alike; an empty
    table gives no rows; extra columns are ignored.
    """
    keys = ["lang", "source"]
    rows = with_counts(only(docs, "doc_id", "text", *keys)).drop("text")
    rows = cut(rows.withColumns({f"m_{m}": F.expr(e) for m, (e, _, _) in METRICS.items()}))
    base = quantile_sketch(rows.filter("n_words > 0"), keys, list(METRICS))
    base = cut(base)  # bins only; read three times
    levels = [fences(base, k) for k in (keys, keys[:1], [])]
    own, by_lang, whole = [
        f.groupBy(*k).agg(
            F.max("rows").alias("rows"),
            F.map_from_entries(F.collect_list(F.struct("metric", F.struct("low", "high")))).alias(f"f{n}"),
        )
        for n, (f, k) in enumerate(zip(levels, (keys, keys[:1], []), strict=True))
    ]
    limits = (
        own.withColumnRenamed("rows", "r0")
        .join(by_lang.select(F.col("lang").alias("_l"), F.col("rows").alias("r1"), "f1"), F.col("lang").eqNullSafe(F.col("_l")))
        .crossJoin(F.broadcast(whole.select("f2")))  # one row
        .select(
            F.col("lang").alias("_lang"), F.col("source").alias("_source"),
            F.when(F.col("r0") >= min_group, F.col("f0")).when(F.col("r1") >= min_group, F.col("f1")).otherwise(F.col("f2")).alias("fences"),
        )
    )
    judged = rows.join(limits, rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source")), "left")
    fine = F.lit(True)
    for m, (_, _, both) in METRICS.items():
        fine &= F.coalesce(F.col(f"m_{m}") <= F.col("fences")[m]["high"], F.lit(True))
        if both:
            fine &= F.coalesce(F.col(f"m_{m}") >= F.col("fences")[m]["low"], F.lit(True))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & fine).alias("kept"),
    )


def op8_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_verdicts(table(spark, sf_dir, "documents"))


def _sql_level(name: str, groups: str) -> str:
    by = f"{groups}, metric" if groups else "metric"
    return f"""
{name} AS (
  SELECT {by}, max(total) AS total,
    min(bin) FILTER (WHERE seen * 100 >= total * {LOW}) AS q_low, min(bin) FILTER (WHERE seen * 100 >= total * {HIGH}) AS q_high,
    greatest(max(slack), {REACH} * (q_high - q_low)) AS reach, q_low - reach AS low, q_high + reach AS high
  FROM (
    SELECT {by}, bin, max(slack) AS slack, sum(count(*)) OVER (PARTITION BY {by} ORDER BY bin) AS seen, sum(count(*)) OVER (PARTITION BY {by}) AS total
    FROM bins GROUP BY {by}, bin)
  GROUP BY {by})"""


OP8_SQL = f"""
WITH {COUNTS_SQL},
shares AS (
  SELECT *, {", ".join(f"({e.replace(' div ', ' // ')})::BIGINT AS m_{m}" for m, (e, _, _) in METRICS.items())} FROM counts),
long_shares AS (
  {" UNION ALL ".join(f"SELECT doc_id, lang, source, n_words, '{m}' AS metric, m_{m} AS v, {s} AS slack, {str(b).lower()} AS both_ways FROM shares" for m, (_, s, b) in METRICS.items())}),
bins AS (
  SELECT *, (v >> greatest(len(bin(v)) - {BITS}, 0)) << greatest(len(bin(v)) - {BITS}, 0) AS bin FROM long_shares WHERE n_words > 0),
{_sql_level("own", "lang, source")}, {_sql_level("by_lang", "lang")}, {_sql_level("whole", "")},
outside AS (
  SELECT DISTINCT s.doc_id
  FROM long_shares s
  JOIN own o ON s.lang IS NOT DISTINCT FROM o.lang AND s.source IS NOT DISTINCT FROM o.source AND s.metric = o.metric
  JOIN by_lang l ON s.lang IS NOT DISTINCT FROM l.lang AND s.metric = l.metric
  JOIN whole w ON s.metric = w.metric
  WHERE v > CASE WHEN o.total >= {MIN_GROUP} THEN o.high WHEN l.total >= {MIN_GROUP} THEN l.high ELSE w.high END
    OR both_ways AND v < CASE WHEN o.total >= {MIN_GROUP} THEN o.low WHEN l.total >= {MIN_GROUP} THEN l.low ELSE w.low END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM shares
"""
