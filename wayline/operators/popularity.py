"""Mention scores, decay, popularity and category ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayline import constants as K
from wayline.functions.scoring import popularity_score, rank_tag
from wayline.operators.merge import merge_upsert, update_from
from wayline.operators.ordering import distributed_row_number
from wayline.session import constant_rows


def category_dimension(spark: SparkSession, names: Sequence[tuple[int, str]] = K.CATEGORY_NAMES) -> DataFrame:
    return constant_rows(spark, names, ["category", "category_name"])


def accumulate_score(state: DataFrame, mentions: DataFrame, key: str = "content_id", score: str = "mention_score") -> DataFrame:
    """Add incoming scores to the stored ones; unknown entities start at their first score."""
    incoming = mentions.groupBy(key).agg(F.sum(score).alias(score))
    added = {score: F.coalesce(F.col(f"t.{score}"), F.lit(0.0)) + F.coalesce(F.col(f"s.{score}"), F.lit(0.0))}
    return merge_upsert(state, incoming, [key], update=[], set_on_match=added)


def decay_scores(state: DataFrame, factor: float = K.MENTION_DECAY, score: str = "mention_score") -> DataFrame:
    """Every stored score times the factor, fresh mentions included."""
    return state.withColumn(score, F.col(score) * F.lit(factor))


def popularity_join(state: DataFrame, entities: DataFrame, categories: DataFrame, key: str = "content_id") -> DataFrame:
    """Score state with its entity and category name; others drop out."""
    wanted = entities.select(key, "category", "like_count", "review_count", "avg_rating")
    return state.join(wanted, key).join(categories, "category")


def category_rank(scored: DataFrame, category: str = "category", score: str = "popularity_score",
                  key: str = "content_id", out: str = "category_rank") -> DataFrame:
    """Rank of every entity in its category, best score first, then higher id.

    A handful of categories hold all rows, so the rank is computed over range
    slices instead of one window task per category. Only category, score and id
    are sliced and stored; further columns meet their rank again by id.
    """
    slim = [category, score, key]
    order = [F.col(score).desc(), F.col(key).desc()]
    if set(scored.columns) == set(slim):
        return distributed_row_number(scored, [category], order, out)
    ranked = distributed_row_number(scored.select(*slim), [category], order, out).select(F.col(key).alias("_ranked"), out)
    return scored.join(ranked, F.col(key) == F.col("_ranked")).drop("_ranked")


def popularity_rank(
    state: DataFrame, entities: DataFrame, categories: DataFrame, now: Column,
    top_n: int = K.RANK_TAG_TOP_N, weights: dict[str, float] | None = None,
) -> DataFrame:
    """New score, rank and tag for all rankable rows; the others keep what they have."""
    score = popularity_score(
        F.col("mention_score"), F.col("like_count"), F.col("review_count"), F.col("avg_rating"), **(weights or {})
    )
    scored = popularity_join(state.select("content_id", "mention_score"), entities, categories).select(
        "content_id", "category", score.alias("popularity_score")
    )
    # The few names come back by category, after the ranking.
    ranked = category_rank(scored).join(categories, "category").select(
        "content_id",
        "popularity_score",
        F.col("category_rank").cast("int").alias("category_rank"),
        rank_tag(F.col("category_name"), F.col("category_rank"), top_n).alias("rank_tag"),
    )
    return update_from(
        state, ranked, ["content_id"], ["popularity_score", "category_rank", "rank_tag"], {"calculated_at": now}
    )


def decay_and_prune(
    scores: DataFrame, category: str, score: str, factors: Sequence[tuple[str, float]] = K.CLASS_DECAY,
    threshold: float = K.DECAY_THRESHOLD,
) -> DataFrame:
    """Decay by place class (other classes keep their score), then drop what faded out."""
    factor = F.coalesce(*[F.when(F.col(category) == name, F.lit(f)) for name, f in factors], F.lit(1.0))
    return scores.withColumn(score, F.col(score) * factor).where(F.col(score) >= threshold)


def feedback_rollup(likes: DataFrame, reviews: DataFrame, key: str = "content_id", rating: str = "rating",
                    deleted: str = "is_deleted") -> DataFrame:
    """Like count, live review count and average rating per entity."""
    liked = likes.groupBy(key).agg(F.count("*").alias("like_count"))
    reviewed = (
        reviews.where(~F.col(deleted))
        .groupBy(key)
        .agg(F.count("*").alias("review_count"), F.avg(rating).cast("decimal(3,2)").alias("avg_rating"))
    )
    return liked.join(reviewed, key, "full_outer").select(
        key,
        F.coalesce("like_count", F.lit(0)).alias("like_count"),
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        F.coalesce("avg_rating", F.lit(0).cast("decimal(3,2)")).alias("avg_rating"),
    )


def trending_merge(trending: DataFrame, keywords: DataFrame, now: Column,
                   keys: Sequence[str] = ("keyword", "city_name")) -> DataFrame:
    """Upsert keyword counts; a row keeps its `promoted` flag, new rows start unpromoted."""
    counts = ["blog_frequency", "cafe_frequency", "multi_channel"]
    return merge_upsert(
        trending,
        keywords.select(*keys, *counts),
        list(keys),
        update=counts,
        insert_defaults={"promoted": F.lit(False), "collected_at": now},
        set_on_match={"collected_at": now},
    )


def unpromoted(trending: DataFrame) -> DataFrame:
    """Keywords still to be verified as places."""
    return trending.where(~F.col("promoted"))
