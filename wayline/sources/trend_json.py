"""Nested trend snapshots: {"cities": {city: {channel: [documents]}}}."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayline import constants as K
from wayline.operators.ordering import distributed_row_number
from wayline.schemas import TREND_DOCUMENT
from wayline.session import constant_rows, materialize, union_rows

CHUNK = 1000


def snapshot_file(base: str, kind: str, execution_date: date, run_id: str) -> str:
    """Folder of one run's snapshot: date, kind and the first 8 characters of the run id."""
    return f"{base.rstrip('/')}/{execution_date}/{kind}_{run_id[:8]}"


def flatten_trend(raw: DataFrame, column: str = "value", channels: Sequence[str] = K.CHANNELS,
                  document: str = TREND_DOCUMENT) -> DataFrame:
    """JSON text to one row per document; entries that are no object or lack a URL are skipped."""
    schema = f"STRUCT<cities: MAP<STRING, STRUCT<{', '.join(f'{c}: ARRAY<STRING>' for c in channels)}>>>"
    by_city = raw.select(F.explode(F.from_json(column, schema)["cities"]).alias("city_name", "_channels"))
    listed = F.array(
        *[F.struct(F.lit(c).alias("channel"), F.col(f"_channels.{c}").alias("_docs")) for c in channels]
    )
    by_channel = by_city.select("city_name", F.inline(listed))
    docs = by_channel.select("city_name", "channel", F.explode("_docs").alias("_text")).where(
        F.col("_text").startswith("{")
    )
    return (
        docs.withColumn("_doc", F.from_json("_text", document))
        .select("city_name", "channel", "_doc.*")
        .where(F.coalesce("url", F.lit("")) != "")
    )


def nest_by(df: DataFrame, group: str, inner: str | None, order_by: Sequence[Column], item: Sequence[str],
            chunk: int = CHUNK) -> DataFrame:
    """Rows to nested JSON lines: {group: [items]} or {group: {inner: [items]}}.

    Every line holds at most `chunk` items of one group, numbered by
    `chunk_no`, so no array outgrows a task however large its group is.
    """
    keys = [group] + ([inner] if inner else [])
    numbered = distributed_row_number(df, keys, order_by, "_rn").withColumn(
        "chunk_no", F.floor((F.col("_rn") - 1) / chunk)
    )
    lists = numbered.groupBy(*keys, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("_rn", F.struct(*item).alias("_item")))).alias("_items")
    )
    nested = F.transform("_items", lambda x: x["_item"])
    if inner:
        nested = F.create_map(F.col(inner), nested)
    return lists.select(*keys, "chunk_no", F.to_json(F.create_map(F.col(group), nested)).alias("json"))


def write_nested(nested: DataFrame, path: str, top: str = "cities") -> str:
    """One JSON object per line, each wrapped as {top: ...}."""
    line = F.concat(F.lit(f'{{"{top}":'), F.col("json"), F.lit("}")).alias("value")
    nested.select(line).write.mode("overwrite").text(path)
    return path


def write_whole(df: DataFrame, path: str, group: str, inner: str | None, order_by: Sequence[Column], item: Sequence[str],
                head: Mapping[str, str] | None = None, top: str = "cities") -> str:
    """The same snapshot as one JSON object over several lines of one file: the `head` fields, then {top: {group: ...}}.

    Every row is one line, with what opens before it and what closes behind the
    row before; lines are put in order over all tasks and written one after the
    other, so no task holds more than the rows it sorts. Groups and inner keys
    come in order of their names. Rows without a group or an inner key are left out.
    """
    keys = [group, inner] if inner else [group]
    rows = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    order = [F.col(inner).asc(), *order_by] if inner else list(order_by)
    numbered = materialize(distributed_row_number(rows, [group], order, "_n"), "whole")
    opens = numbered.groupBy(*keys).agg(F.min("_n").alias("_n")).withColumn("_opens", F.lit(True))
    first = numbered.agg(F.min(group)).scalar()
    name = lambda c: F.regexp_extract(F.to_json(F.create_map(F.col(c), F.lit(""))), r'^\{(.*):""\}$', 1)
    begins, new = F.col("_n") == 1, F.coalesce("_opens", F.lit(False))
    closing = F.when(begins & (F.col(group) == first), "").when(begins, "]}," if inner else "],").when(new, "],").otherwise(",")
    opening = F.when(begins, F.concat(name(group), F.lit(":{" if inner else ":["))).otherwise("")
    if inner:
        opening = F.concat(opening, F.when(new, F.concat(name(inner), F.lit(":["))).otherwise(""))
    lines = numbered.join(opens, [*keys, "_n"], "left").select(
        F.lit(1).alias("_part"), group, "_n", F.concat(closing, opening, F.to_json(F.struct(*item))).alias("value")
    )
    start = "{" + "".join(f"{json.dumps(k)}:{json.dumps(v)}," for k, v in (head or {}).items()) + f"{json.dumps(top)}:{{"
    end = "}}" if numbered.isEmpty() else "]}}}" if inner else "]}}"
    frame = constant_rows(df.sparkSession, [(0, start), (2, end)], ["_part", "value"])
    union_rows(lines, frame, allow_missing=True).orderBy("_part", group, "_n").select("value").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON object, which may span several lines; anything else fails the read."""
    lines = spark.read.text(path)
    whole = F.trim("value").startswith("{") & F.trim("value").endswith("}")
    if lines.where((F.trim("value") != "") & ~(whole & F.expr("try_parse_json(value)").isNotNull())).isEmpty():
        return lines.where(F.trim("value") != "")
    texts = read_whole(spark, path)
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 80)))
    return texts.select(F.when(F.expr("try_parse_json(value)").isNull(), broken).otherwise(F.col("value")).alias("value"))


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots written as one indented JSON object per file."""
    return spark.read.text(path, wholetext=True)
