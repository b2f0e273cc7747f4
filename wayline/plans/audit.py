"""Declared constraints of the stored tables as one report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayline import constants as K
from wayline.operators.quality import check_domain, check_orphans, check_unique
from wayline.session import union_rows
from wayline.sources.tables import Tables

UNIQUE = {
    "area_code": ["area_code"],
    "sigungu_code": ["area_code", "sigungu_code"],
    "category": ["code"],
    "entity": ["content_id"],
    "entity_image": ["content_id", "order"],
    "entity_embedding": ["content_id"],
    "etl_state": ["content_id"],
    "etl_run": ["dag_id", "run_id"],
    "source_document": ["city_name", "channel", "source_url"],
    "popularity": ["content_id"],
    "review": ["content_id", "user_id"],
    "review_image": ["review_id", "display_order"],
    "entity_like": ["user_id", "content_id"],
}

# Child table, child key, parent table, parent key.
REFERENCES = (
    ("sigungu_code", "area_code", "area_code", "area_code"),
    ("entity_image", "content_id", "entity", "content_id"),
    ("entity_embedding", "content_id", "entity", "content_id"),
    ("popularity", "content_id", "entity", "content_id"),
    ("review", "content_id", "entity", "content_id"),
    ("review_image", "review_id", "review", "review_id"),
    ("entity_like", "content_id", "entity", "content_id"),
)


def _domains():
    return {
        "entity": {"category_known": F.col("category").between(1, len(K.CATEGORY_NAMES)), "title_set": F.col("title").isNotNull()},
        "review": {"rating_1_to_5": F.col("rating").between(1, 5)},
        "source_document": {"channel_known": F.col("channel").isin(*K.CHANNELS), "url_set": F.col("source_url").isNotNull()},
    }


def audit(tables: Tables) -> DataFrame:
    """Violations per table and rule: keys that repeat, values out of range, missing parents."""
    label = lambda rows, table, rule: rows.select(
        F.lit(table).alias("table"), rule.alias("rule"), F.col("violations").cast("bigint").alias("violations")
    )
    total = lambda df: df.agg(F.count("*").alias("violations"))
    reports = [label(total(check_unique(tables.read(t), keys)), t, F.lit("unique_key")) for t, keys in UNIQUE.items()]
    reports += [label(check_domain(tables.read(t), rules), t, F.col("rule")) for t, rules in _domains().items()]
    reports += [
        label(total(check_orphans(tables.read(c), tables.read(p), ck, pk)), c, F.lit(f"{ck}_in_{p}"))
        for c, ck, p, pk in REFERENCES
    ]
    return union_rows(*reports)
