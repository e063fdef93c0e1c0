"""Length buckets of least padding and token-budget batches (operator 5)."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import cut, only, prefix_totals, table, words

N_BUCKETS = 16
#: Padded tokens of a batch.
BUDGET = 65_536


def word_tokens(text: Column) -> Column:
    """Tokens of a text: its words and one end."""
    return (F.size(words(text)) + 1).cast("long")


def tokenizer_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) by a public tokenizer's JSON file that every executor can open, plus one end."""

    def counted(batches):
        import pyarrow as pa
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        for b in batches:
            n = [len(made.encode(t or "", add_special_tokens=False).ids) + 1 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(counted, f"doc_id {kind}, n_tokens long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, k: int) -> list[int]:
    """Upper bounds of at most ``k`` buckets over sorted unlike lengths that leave the least padding.

    Dynamic programming over the number of buckets and the last length: padding of
    lengths i..j in one bucket is lengths[j] * (rows in them) - (tokens in them).  For
    a given last length, each bucket before it is a line in that length, so the least
    is read from the lines' lower hull, in time linear in the lengths for each bucket.
    """
    n, k = len(lengths), min(k, len(lengths))
    tops = [int(x) for x in lengths]  # whole numbers of any size: products outgrow 64 bits
    rows, tokens = ([0, *itertools.accumulate(int(x) for x in xs)] for xs in (counts, sums))
    cost = [top * r - t for top, r, t in zip(tops, rows[1:], tokens[1:], strict=True)]  # one bucket for the first j + 1
    back = np.zeros((k, n), dtype=np.int64)
    for b in range(1, k):
        new, hull, at = [0] * n, [], 0  # hull: (slope, height, last of the bucket before)
        for j in range(b, n):
            slope, height = -rows[j], cost[j - 1] + tokens[j]
            while len(hull) > at + 1:
                (s1, h1, _), (s2, h2, _) = hull[-2], hull[-1]
                if (height - h1) * (s1 - s2) > (h2 - h1) * (s1 - slope):
                    break
                hull.pop()
            hull.append((slope, height, j - 1))
            x = tops[j]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            best = hull[at]
            new[j], back[b, j] = best[0] * x + best[1] + x * rows[j + 1] - tokens[j + 1], best[2]
        cost = new
    bounds, j = [], n - 1
    for b in range(k - 1, -1, -1):
        bounds.append(tops[j])
        if j == 0 or b == 0:
            break
        j = int(back[b, j]) if j >= b else j - 1
    return sorted(set(bounds))


def pack(lengths: DataFrame, n_buckets: int = N_BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Bucket, padded length, batch and place in it of every row of (doc_id, n_tokens).

    The global histogram of lengths, counted with map-side aggregation, goes to the
    driver, where dynamic programming picks the bucket bounds of least padding.  So
    many unlike lengths have a sum of half their number's square at least: a corpus
    of T tokens has at most the square root of 2 T of them (6 million for 20 trillion
    tokens, two numbers each).  Inside a bucket, rows in the order of doc_id form
    batches of as many rows as the budget of padded tokens allows, one at least: a
    longer document is a batch of its own.

    Rows of equal doc_id stand in the order in which they were read; null ids come
    first; a null length has no place; extra columns are ignored; an empty table gives
    no rows; a length over the budget, however great, pads to its bucket like others.
    """
    lengths = cut(only(lengths, "doc_id", "n_tokens").filter("n_tokens IS NOT NULL"))
    bins = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow()
    order = np.argsort(bins.column("n_tokens").to_numpy())
    top, n = (bins.column(c).to_numpy()[order].astype(np.int64) for c in ("n_tokens", "n"))
    bounds = best_bounds(top, n, top * n, n_buckets) if len(top) else [1]
    firsts = [int(n[top <= b].sum()) for b in [0, *bounds[:-1]]]
    place = F.lit(0)
    for b in bounds[:-1]:
        place = place + (F.col("n_tokens") > b).cast("int")
    at = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("bucket"))
    rows = prefix_totals(lengths.withColumn("bucket", place), ["bucket", "doc_id"], {"_rank": "1"})
    rows = rows.withColumn("pad_to", at(bounds)).withColumn("_rank", F.col("_rank") - at(firsts))
    rows = rows.withColumn("_room", F.expr(f"greatest(1L, {int(budget)}L div pad_to)"))
    return rows.select(
        "doc_id", "n_tokens", "bucket", "pad_to", F.expr("_rank div _room").alias("batch"), (F.col("_rank") % F.col("_room")).alias("slot")
    )


def pack_documents(docs: DataFrame, n_buckets: int = N_BUCKETS, budget: int = BUDGET, tokenizer: str | None = None) -> DataFrame:
    """``pack`` over whole texts: words and an end as tokens, or those of a tokenizer file.

    Null and blank texts have the end alone; texts of any length are counted whole.
    See ``pack`` for ties, repeated rows, empty tables and extra columns.
    """
    if tokenizer is None:
        lengths = docs.select("doc_id", word_tokens(F.col("text")).alias("n_tokens"))
    else:
        lengths = tokenizer_counts(docs, tokenizer)
    return pack(lengths, n_buckets, budget)


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
