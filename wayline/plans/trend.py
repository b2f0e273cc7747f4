"""Hourly mention trend: documents to keywords, places, scores and ranks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayline import constants as K
from wayline.functions.text import document_text
from wayline.operators.documents import (
    city_collection_stats, doc_dedup_collect, in_folders, prefix_until_seen, reachable_pages, required_key,
)
from wayline.operators.keywords import keyword_scores
from wayline.operators.merge import insert_ignore
from wayline.operators.normalize import region_alias_expand
from wayline.operators.popularity import accumulate_score, category_dimension, decay_scores, popularity_rank
from wayline.operators.resolve import best_candidate, candidate_filter, dim_lookup_skip, place_match, tag_cities
from wayline.plans.runs import recorded
from wayline.session import constant_rows, materialize, union_rows
from wayline.sources import files, trend_json
from wayline.sources.tables import Tables

_QUERY = ["city_name", "channel", "query"]
_DOC = ["city_name", "channel", "url"]
KEYWORD_FIELDS = {
    "keyword": "STRING", "city_name": "STRING", "blog_frequency": "BIGINT", "cafe_frequency": "BIGINT",
    "multi_channel": "BOOLEAN", "raw_score": "DOUBLE", "normalized_score": "DOUBLE",
}


def city_dimension(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, K.CITIES, ["city_name", "short_name", "longitude", "latitude"])


def stop_list(spark: SparkSession, regions: DataFrame | None = None) -> DataFrame:
    """Travel stop words and region names with their short forms; `regions` (name) adds those of a code table."""
    words = constant_rows(spark, [(w,) for w in K.STOPWORDS], ["name"])
    provinces = constant_rows(spark, [(p,) for p in K.PROVINCES], ["name"])
    districts = constant_rows(spark, [(d,) for d in K.DISTRICTS], ["name"])
    named = districts if regions is None else union_rows(districts, regions.select("name"))
    return union_rows(words, region_alias_expand(named, "name", provinces))


def collect(docs: DataFrame, tables: Tables, run_id: str, page_size: int = K.PAGE_SIZE, max_pages: int | None = None) -> DataFrame:
    """New documents of this run, stored once; their URLs enter the ledger.

    The landed pages are stored once and the ledger is scanned once, in the
    folders of the run's cities and channels; what it knows of the run's URLs
    answers both where to stop and what to add.
    """
    pages = materialize(
        reachable_pages(docs, _QUERY, "page", page_size, max_pages).withColumn(
            "pos", (F.col("page").cast("bigint") - 1) * max(1, page_size) + F.col("idx")
        ),
        "pages",
    )
    known = materialize(known_urls(pages, tables.read("source_document")), "known")
    seen = known.where(F.col("first_run_id") != run_id).withColumnRenamed("source_url", "url")
    fresh = prefix_until_seen(pages, seen, _DOC, _QUERY, "pos")
    unique = materialize(
        doc_dedup_collect(fresh, _DOC, ["query_no", "pos"], "query", ["datetime", "title", "contents"]), "documents"
    )
    rows = unique.select(
        "city_name", "channel", F.col("url").alias("source_url"),
        F.col("datetime").try_cast("timestamp").alias("published_at"), F.lit(run_id).alias("first_run_id"),
    )
    added = insert_ignore(known, rows, ["city_name", "channel", "source_url"])
    tables.append("source_document", added, token=run_id)
    return unique


def known_urls(pages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows of the pages' documents, from the folders of their cities and channels alone."""
    incoming = required_key(pages).select("city_name", "channel", F.col("url").alias("source_url"))
    keys = ["city_name", "channel", "source_url"]
    part = in_folders(ledger, incoming, ["city_name", "channel"]).select(*keys, "first_run_id")
    return part.join(incoming.distinct(), keys, "left_semi")


def analyse(docs: DataFrame, stop: DataFrame, load=None, **options) -> DataFrame:
    """Keyword scores of the collected documents."""
    text = document_text(F.col("title"), F.col("contents"))
    return keyword_scores(docs, text, "city_name", "channel", stop, load=load, **options)


def export_documents(docs: DataFrame, base: str, execution_date: date, run_id: str, whole: bool = False) -> str:
    """Collected documents as the run's nested raw snapshot, JSON lines or one whole object; returns its path."""
    rows = docs.withColumnRenamed("datetime", "published_at")
    fields = ["url", "published_at", "title", "contents", "matched_queries"]
    if whole:
        path = trend_json.snapshot_file(base, "raw", execution_date, run_id)
        return trend_json.write_whole(rows, path, "city_name", "channel", [F.col("url").asc()], fields, {"collected_at": str(execution_date)})
    nested = trend_json.nest_by(rows, "city_name", "channel", [F.col("url").asc()], fields)
    return trend_json.write_nested(nested, trend_json.snapshot_file(base, "raw", execution_date, run_id))


def export_keywords(keywords: DataFrame, base: str, execution_date: date, run_id: str) -> str:
    """Scored keywords as the run's nested aggregated snapshot, best first; returns its path."""
    order = [F.col("raw_score").desc(), F.col("keyword").asc()]
    nested = trend_json.nest_by(keywords, "city_name", None, order, list(KEYWORD_FIELDS))
    return trend_json.write_nested(nested, trend_json.snapshot_file(base, "aggregated", execution_date, run_id))


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Keyword rows of an aggregated snapshot."""
    item = ", ".join(f"{name}: {kind}" for name, kind in KEYWORD_FIELDS.items())
    cities = F.from_json("value", f"STRUCT<cities: MAP<STRING, ARRAY<STRUCT<{item}>>>>")["cities"]
    listed = trend_json.read_nested(spark, path).select(F.explode(cities).alias("city", "_items"))
    return listed.select(F.inline("_items"))


def match(keywords: DataFrame, candidates: DataFrame, entities: DataFrame, cities: DataFrame) -> DataFrame:
    """Keywords with the entity they stand for; NULL where verification or matching failed."""
    known, _ = dim_lookup_skip(keywords, cities, "city_name")
    places = best_candidate(candidate_filter(candidates, cities)).select(
        "city_name", "keyword", "place_name", F.col("x").try_cast("double").alias("longitude"),
        F.col("y").try_cast("double").alias("latitude"),
    )
    verified = known.join(places, ["city_name", "keyword"])
    located = place_match(verified, tag_cities(entities, cities)).select("city_name", "keyword", "content_id")
    names = places.select("city_name", "keyword", F.lit(True).alias("verified"))
    return known.join(names, ["city_name", "keyword"], "left").join(located, ["city_name", "keyword"], "left")


def match_stats(matched: DataFrame) -> DataFrame:
    verified, found = F.coalesce("verified", F.lit(False)), F.col("content_id").isNotNull()
    return matched.agg(
        F.count("*").alias("searched"),
        F.count(F.when(~verified, 1)).alias("unverified"),
        F.count(F.when(verified & ~found, 1)).alias("unmatched"),
        F.count(F.when(found, 1)).alias("matched"),
    )


def documents_of(docs: DataFrame, tables: Tables, run_id: str, snapshots: tuple[str, date] | None, **options) -> DataFrame:
    """The run's new documents: those of its raw snapshot if there is one, else collected and, if asked for, exported.

    `snapshots`: base folder and logical date. A repeated run so reads what it
    stored, and does not collect anew from pages that may have changed since.
    Snapshots are named by date and the first 8 characters of the run id; a run
    that has not collected yet replaces one of that name.
    """
    if snapshots is None:
        return collect(docs, tables, run_id, **options)
    base, execution_date = snapshots
    path = trend_json.snapshot_file(base, "raw", execution_date, run_id)
    if not (tables.applied("source_document", run_id) and files.committed(tables.spark, path)):
        export_documents(collect(docs, tables, run_id, **options), base, execution_date, run_id)
    return trend_json.flatten_trend(trend_json.read_nested(tables.spark, path))


def hourly_trend(
    docs: DataFrame, candidates: DataFrame, tables: Tables, cities: DataFrame, stop: DataFrame, run_id: str,
    now: Column, load=None, collect_options: dict | None = None, snapshots: tuple[str, date] | None = None, **options,
) -> DataFrame:
    """One run; returns its match counters.

    Scores add up, so the run id is the version token of the score table: a
    repeated run finds its version and does not add again. The run's row in
    the ledger also has the documents and cities collected. With `snapshots`
    the collected documents and the scored keywords are exported, and a
    repeated run starts from the stored documents.
    """

    def job() -> DataFrame:
        fresh = documents_of(docs, tables, run_id, snapshots, **(collect_options or {}))
        keywords = analyse(fresh, stop, load, **options)
        if snapshots is not None:
            keywords = materialize(keywords, "keywords")
            export_keywords(keywords, *snapshots, run_id)
        matched = materialize(match(keywords, candidates, tables.read("entity"), cities), "matched")
        if not tables.applied("popularity", run_id):
            mentions = matched.where("content_id IS NOT NULL").select(
                "content_id", F.col("normalized_score").alias("mention_score")
            )
            scores = decay_scores(accumulate_score(tables.read("popularity"), mentions))
            ranked = popularity_rank(scores, tables.read("entity"), category_dimension(tables.spark), now)
            tables.write("popularity", ranked, token=run_id)
        return match_stats(matched).crossJoin(collection_counters(fresh))

    return recorded(tables, "hourly_trend", run_id, now, job).drop("documents", "cities")


def collection_counters(docs: DataFrame) -> DataFrame:
    """How many documents a run has collected, and from how many cities."""
    total = F.col("city_name").isNull()
    sums = city_collection_stats(docs.where("city_name IS NOT NULL"))
    return sums.agg(
        F.coalesce(F.max(F.when(total, F.col("documents"))), F.lit(0)).alias("documents"),
        F.count(F.when(F.col("channel").isNull() & ~total, 1)).alias("cities"),
    )
