"""Raw listing snapshots: one immutable header CSV per logical date, all text."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayline.session import union_rows
from wayline.sources import files

EMPTY_HEADER = "_empty"

# Quotes are doubled, blanks and line ends inside values are kept as they are.
_CSV = {
    "header": "true", "escape": '"', "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# A quoted line end makes a file unsplittable, so files are kept small enough
# to be read by one task each.
_ROWS_PER_FILE = 500_000


def snapshot_path(base: str, execution_date: date) -> str:
    return f"{base.rstrip('/')}/execution_date={execution_date:%Y%m%d}"


def union_by_keys(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows with different keys under the sorted union of their keys, all text."""
    text = [df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) for df in frames]
    merged = union_rows(*text, allow_missing=True)
    return merged.select(*sorted(merged.columns))


def write_snapshot(frames: Sequence[DataFrame], base: str, execution_date: date) -> str:
    """Write the day's snapshot unless it exists; returns its path.

    No rows at all give a file with only the `_empty` header.
    """
    spark = frames[0].sparkSession
    path = snapshot_path(base, execution_date)
    if files.committed(spark, path):
        return path
    rows = union_by_keys(frames)
    if not rows.columns or rows.isEmpty():
        spark.createDataFrame([(EMPTY_HEADER,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        rows.write.mode("overwrite").options(**_CSV).option("maxRecordsPerFile", _ROWS_PER_FILE).csv(path)
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Every field as text; a snapshot whose only header is `_empty` has no rows."""
    rows = spark.read.options(**_CSV).option("multiLine", "true").option("inferSchema", "false").csv(path)
    return rows.limit(0) if rows.columns == [EMPTY_HEADER] else rows
