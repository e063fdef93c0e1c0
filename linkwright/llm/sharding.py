"""Balanced contiguous shards by bytes (operator 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import only, prefix_totals, table

N_SHARDS = 16


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut the documents, in the order of ``key``, into ``n_shards`` runs of near equal bytes.

    The law is ``bytes``: a row's size is its text's UTF-8 length plus 1, its start
    is the prefix sum of the sizes before it, and the shard is the one of
    ``n_shards`` equal byte ranges that holds the row's middle.  A shard's size so
    differs from the mean by half a row at either cut at most.  Equal texts are
    not kept together: the law looks at bytes alone.

    Null texts count as empty (size 1, crc 0); null keys come first; repeated rows
    each get a place of their own; an empty table gives no rows; other columns are
    ignored.  ``slot`` counts from 0 inside each shard.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = only(docs, key, text).select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).cast("long").alias("text_crc32"),
    )
    placed = prefix_totals(rows, ["doc_id"], {"_before": "size", "_rank": "1"})
    total = placed.agg(F.max(F.col("_before") + F.col("size")).alias("_total"))  # one row
    placed = placed.crossJoin(F.broadcast(total)).withColumn(
        "shard", F.least(F.lit(n_shards - 1), F.expr(f"cast((2 * _before + size) * {int(n_shards)}L div (2 * _total) as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # n_shards rows at most
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


#: CRC-32 as SQL: the table of 256 remainders by rule, then one step per byte.
CRC_TABLE = """
crc_steps AS (SELECT list(c ORDER BY b) AS t FROM (
  SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) AS c
  FROM (SELECT unnest(range(256)) AS b)))
"""


def crc_sql(text: str) -> str:
    """CRC-32 of a UTF-8 text as a DuckDB expression; needs ``crc_steps`` in scope."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(4294967295, list_reduce({octets}, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT))"


OP9_SQL = f"""
WITH {CRC_TABLE},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {crc_sql("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_steps),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(size) OVER () AS total
  FROM sized),
cuts AS (
  SELECT *, least(15, ((2 * before + size) * 16) // (2 * total)) AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, NULL::INT AS grown_shard
FROM cuts
"""
