"""From landed API pages to code tables and the day's listing snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from wayline.operators.changes import dedup_last_wins
from wayline.operators.merge import merge_upsert, update_from
from wayline.operators.normalize import normalize_codes
from wayline.operators.popularity import feedback_rollup
from wayline.operators.quality import parent_code
from wayline.session import materialize
from wayline.sources import files, pages as P, snapshots as S
from wayline.sources.tables import Tables


class ListingFailed(RuntimeError):
    """A page of the listing is an error, an exhausted quota or missing, or its end was not reached: no snapshot is made."""


def land_listing(pages: DataFrame, base: str, execution_date: date, request: str = "request") -> str:
    """Snapshot of a paged listing, one per logical date; returns its path.

    `pages`: request, page_no, num_rows, body. The column `seq` keeps the
    listing order (request, page, item) as sortable text.
    """
    spark = pages.sparkSession
    path = S.snapshot_path(base, execution_date)
    if files.committed(spark, path):
        return path
    kept = materialize(P.assemble_pages(P.parse_pages(pages), [request]), "listing")
    broken = kept.where(F.col("status").isin("quota", "error")).select("status", "result_code").first()
    if broken:
        raise ListingFailed(f"{broken['status']} {broken['result_code']}")
    gap = _unfinished(kept, request).first()
    if gap:
        raise ListingFailed(f"request {gap[request]}: pages up to {gap['last']}, {gap['n']} of them landed, total {gap['low']} to {gap['high']}")
    items = P.page_items(kept, [request]).withColumn(
        "seq", F.format_string("%s|%010d|%06d", F.col(request).cast("string"), "page_no", "item_no")
    )
    return S.write_snapshot([P.items_to_columns(items, keep=["seq"])], base, execution_date)


def _unfinished(kept: DataFrame, request: str) -> DataFrame:
    """Requests of which a page is missing, the end was not reached, or the total changed between pages."""
    ended = (F.col("page_no") * F.col("num_rows") >= F.col("total_count")) | (F.size("items") == 0)
    walked = kept.groupBy(request).agg(
        F.max("page_no").alias("last"), F.count_distinct("page_no").alias("n"), F.min("page_no").alias("first"),
        F.bool_or(ended).alias("ended"), F.min("total_count").alias("low"), F.max("total_count").alias("high"),
    )
    return walked.where(~F.col("ended") | (F.col("first") != 1) | (F.col("n") != F.col("last")) | (F.col("low") != F.col("high")))


def sync_codes(areas: DataFrame, districts: DataFrame, categories: DataFrame, tables: Tables) -> None:
    """Upsert the code tables from listed items.

    `areas`: code, name. `districts`: area_code, code, name. `categories`:
    code, name, depth, level1, level2 (the codes they were listed under).
    """
    area_rows = normalize_codes(areas).withColumnRenamed("code", "area_code")
    district_rows = normalize_codes(districts, {"area_code": F.col("area_code")}).withColumnRenamed("code", "sigungu_code")
    category_rows = normalize_codes(
        categories, {"depth": F.col("depth"), "parent_code": parent_code(F.col("level1"), F.col("level2"))}
    )
    _upsert(tables, "area_code", area_rows, ["area_code"])
    _upsert(tables, "sigungu_code", district_rows, ["area_code", "sigungu_code"])
    _upsert(tables, "category", category_rows, ["code"])


def _upsert(tables: Tables, name: str, rows: DataFrame, keys: Sequence[str]) -> None:
    unique = dedup_last_wins(rows, keys, [c for c in rows.columns if c not in keys])
    tables.write(name, merge_upsert(tables.read(name), unique, keys))


def codes_missing(tables: Tables, area_code: str) -> bool:
    """True when an area has no district codes yet, so that the codes must be synced first."""
    return tables.read("sigungu_code").where(F.col("area_code") == area_code).isEmpty()


def refresh_feedback(tables: Tables) -> DataFrame:
    """Like count, review count and average rating of all entities from the stored feedback."""
    entities = tables.read("entity")
    rolled = feedback_rollup(tables.read("entity_like"), tables.read("review"))
    full = entities.select("content_id").join(rolled, "content_id", "left").select(
        "content_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("like_count", "review_count", "avg_rating")]
    )
    return tables.write("entity", update_from(entities, full, ["content_id"], ["like_count", "review_count", "avg_rating"]))
