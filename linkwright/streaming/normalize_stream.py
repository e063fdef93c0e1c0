"""Normalising record files as they come: a file stream that resumes from its checkpoint."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkwright.functions.text import text
from linkwright.operators.normalize import normalize
from linkwright.sources.records import COLUMNS


def normalize_files(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 8) -> StreamingQuery:
    """Normalise all record files in a folder that haven't been, then stop.

    Each batch is committed to parquet once; a run that is stopped goes on with the
    files that it hadn't committed.
    """
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    rows = spark.readStream.schema(schema).options(sep="\t", header=True, quote="", maxFilesPerTrigger=files_per_batch).csv(source)
    rows = rows.select(*[text(F.col(c)).alias(c) for c in COLUMNS])
    out = normalize(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return out.option("compression", "zstd").trigger(availableNow=True).start()
