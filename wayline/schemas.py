"""Schemas of the stored tables, as DDL strings."""

from __future__ import annotations

ENTITY = """content_id BIGINT, content_type_id STRING, title STRING, addr1 STRING, addr2 STRING,
zipcode STRING, map_x DECIMAL(13,10), map_y DECIMAL(13,10), map_level SMALLINT, ldong_regn_code STRING,
ldong_signgu_code STRING, sigungu_code STRING, category INT, first_image STRING, created_time TIMESTAMP_NTZ,
collected_at TIMESTAMP_NTZ, homepage STRING, overview STRING, infocenter STRING, usetime STRING,
restdate STRING, parking STRING, expguide STRING, detail_info STRING, like_count INT,
avg_rating DECIMAL(3,2), review_count INT"""

STATE = """content_id BIGINT, content_hash STRING, detail_common_pending BOOLEAN, detail_intro_pending BOOLEAN,
detail_info_pending BOOLEAN, image_pending BOOLEAN, embed_pending BOOLEAN, image_absent BOOLEAN,
last_etl_at TIMESTAMP_NTZ"""

TABLES = {
    "area_code": "area_code STRING, name STRING",
    "sigungu_code": "area_code STRING, sigungu_code STRING, name STRING",
    "category": "code STRING, depth INT, name STRING, parent_code STRING",
    "entity": ENTITY,
    "entity_image": "content_id BIGINT, `order` INT, image_url STRING",
    "entity_embedding": "content_id BIGINT, embedding ARRAY<FLOAT>, input_text STRING, keyword_text STRING, created_at TIMESTAMP_NTZ",
    "etl_state": STATE,
    "etl_run": "dag_id STRING, run_id STRING, status STRING, started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, stats STRING",
    "source_document": "city_name STRING, channel STRING, source_url STRING, published_at TIMESTAMP, first_run_id STRING",
    "popularity": "content_id BIGINT, mention_score DOUBLE, popularity_score DOUBLE, category_rank INT, rank_tag STRING, calculated_at TIMESTAMP_NTZ",
    "review": "review_id BIGINT, content_id BIGINT, user_id BIGINT, rating INT, is_deleted BOOLEAN, created_at TIMESTAMP_NTZ",
    "review_image": "review_id BIGINT, display_order INT, image_url STRING",
    "entity_like": "user_id BIGINT, content_id BIGINT, created_at TIMESTAMP_NTZ",
}

#: Tables stored in buckets of a key, so that a few changes rewrite a few buckets.
KEYED = {"entity": "content_id", "etl_state": "content_id", "entity_image": "content_id"}
#: Tables stored in folders of these columns, so that readers of a few values open those only.
PARTITIONED = {"source_document": ["city_name", "channel"]}

# Landed inputs.
SEARCH_DOCUMENT = "city_name STRING, channel STRING, query STRING, query_no INT, page INT, idx INT, url STRING, datetime STRING, title STRING, contents STRING"
PLACE_CANDIDATE = """city_name STRING, keyword STRING, pos INT, id STRING, place_name STRING,
category_group_code STRING, category_group_name STRING, road_address_name STRING, address_name STRING,
phone STRING, x STRING, y STRING"""
DETAIL_RESPONSE = "content_id BIGINT, status STRING, items ARRAY<MAP<STRING,STRING>>"
TREND_DOCUMENT = "STRUCT<url: STRING, published_at: STRING, title: STRING, contents: STRING, matched_queries: ARRAY<STRING>>"
