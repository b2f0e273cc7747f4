"""Landed pages of a paged listing API."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wayline import constants as K
from wayline.operators.ordering import first_per_group

_ENVELOPE = """response STRUCT<
header: STRUCT<resultCode: STRING, resultMsg: STRING>,
body: STRUCT<items: STRING, totalCount: STRING>>"""
_ITEM = "MAP<STRING,STRING>"


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Status, total count and items of each page body.

    `items` may be blank, one object or a list; a page that is not `ok` has
    none. An unreadable body counts as an error with code UNKNOWN.
    """
    keep = [c for c in pages.columns if c != body]
    envelope = pages.withColumn("_e", F.from_json(F.col(body), _ENVELOPE)["response"])
    code = F.coalesce(F.trim(F.col("_e.header.resultCode")), F.lit(""))
    item = F.get_json_object(F.col("_e.body.items"), "$.item")
    status = (
        F.when(F.col("result_code").isin(*K.OK_CODES), "ok")
        .when(F.col("result_code").isin(*K.NO_DATA_CODES), "nodata")
        .when(F.col("result_code").isin(*K.QUOTA_CODES), "quota")
        .otherwise("error")
    )
    none = F.array().cast(f"array<{_ITEM}>")
    items = (
        F.when(F.col("status") != "ok", none)
        .when(F.col("_item").startswith("["), F.from_json("_item", f"ARRAY<{_ITEM}>"))
        .when(F.col("_item").startswith("{"), F.array(F.from_json("_item", _ITEM)))
        .otherwise(none)
    )
    total = F.when(F.col("status") == "ok", F.col("_e.body.totalCount").try_cast("bigint"))
    return (
        envelope.withColumn("result_code", F.when(code == "", "UNKNOWN").otherwise(code))
        .withColumn("_item", item)
        .withColumn("status", status)
        .select(*keep, "status", "result_code", F.coalesce(total, F.lit(0)).cast("bigint").alias("total_count"),
                F.coalesce(items, none).alias("items"))
    )


def assemble_pages(
    parsed: DataFrame, request: Sequence[str], page_no: str = "page_no", num_rows: str = "num_rows"
) -> DataFrame:
    """Pages up to the logical end of each request.

    The end is the first page that reaches the total count or has no items.
    The end page is one aggregated row per request, joined back.
    """
    terminal = (F.col(page_no) * F.col(num_rows) >= F.col("total_count")) | (F.size("items") == 0)
    ends = parsed.where(terminal).groupBy(*[F.col(r).alias(f"_r_{r}") for r in request]).agg(F.min(page_no).alias("_end"))
    same = reduce(lambda a, b: a & b, [F.col(r).eqNullSafe(F.col(f"_r_{r}")) for r in request])
    kept = parsed.join(ends, same, "left").where(F.col("_end").isNull() | (F.col(page_no) <= F.col("_end")))
    return kept.select(*parsed.columns)


def page_items(assembled: DataFrame, request: Sequence[str], page_no: str = "page_no") -> DataFrame:
    """One row per item with its place in the listing: page and index on the page."""
    return assembled.select(*request, page_no, F.posexplode("items").alias("item_no", "item"))


def items_to_columns(items: DataFrame, keep: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """Items of dynamic keys as one text column per field.

    `fields` are the declared field names of the API; without them the names
    that occur are gathered, which is a schema, not data.
    """
    if fields is None:
        names = items.select(F.explode(F.map_keys("item")).alias("name")).distinct().collect()
        fields = sorted(r["name"] for r in names)
    return items.select(*keep, *[F.col("item")[name].alias(name) for name in fields])


def first_item(parsed: DataFrame, request: Sequence[str], page_no: str = "page_no") -> DataFrame:
    """Single-row lookup: first item of the first page."""
    first_page = first_per_group(parsed, request, [F.col(page_no).asc()])
    return first_page.where(F.size("items") > 0).select(*request, F.col("items")[0].alias("item"))
