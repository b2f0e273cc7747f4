"""Messages for the downstream consumer, as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_outbox(batches: DataFrame, path: str) -> DataFrame:
    """Write one message per line and return the accepted count."""
    batches.select(F.col("message").alias("value")).write.mode("overwrite").text(path)
    sent = batches.sparkSession.read.text(path)
    ids = F.from_json("value", "runId STRING, contentIds ARRAY<STRING>")["contentIds"]
    return sent.agg(F.coalesce(F.sum(F.size(ids)), F.lit(0)).alias("accepted"))
