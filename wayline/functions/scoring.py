"""Hashes, category rules, scores and rank labels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from wayline import constants as K


def content_hash(fields: Sequence[Column], version: str = K.CONTENT_HASH_VERSION) -> Column:
    """SHA-256 over the rule version and the raw, untrimmed field values in order."""
    values = [F.coalesce(c.cast("string"), F.lit("")) for c in fields]
    return F.sha2(F.concat_ws("|", F.lit(version), *values), 256)


def classify_category(
    level1: Column,
    level2: Column,
    rules: Iterable[tuple[str, str | None, int]] = K.CATEGORY_RULES,
    otherwise: Column | None = None,
) -> Column:
    """Category number by the first rule that fits; `otherwise` keeps an existing value."""
    branches = []
    for want1, want2, category in rules:
        fits = level1 == want1 if want2 is None else (level1 == want1) & (level2 == want2)
        branches.append(F.when(fits, F.lit(category)))
    fallback = F.lit(None).cast("int") if otherwise is None else otherwise
    return F.coalesce(*branches, fallback).cast("int")


def diversity_score(total: Column, multi_channel: Column, bonus: float = K.DIVERSITY_BONUS) -> Column:
    """Frequency, raised by the bonus when both channels mention the keyword."""
    return F.when(multi_channel, total * F.lit(bonus)).otherwise(total.cast("double"))


def popularity_score(
    mention: Column,
    likes: Column,
    reviews: Column,
    rating: Column,
    mention_weight: float = K.MENTION_WEIGHT,
    like_weight: float = K.LIKE_WEIGHT,
    review_weight: float = K.REVIEW_WEIGHT,
    rating_weight: float = K.RATING_WEIGHT,
) -> Column:
    return (
        mention * F.lit(mention_weight)
        + likes * F.lit(like_weight)
        + reviews * F.lit(review_weight)
        + rating.cast("double") * reviews * F.lit(rating_weight)
    )


def rank_tag(name: Column, rank: Column, top_n: int = K.RANK_TAG_TOP_N, parts=K.RANK_TAG_FORMAT) -> Column:
    """Label for the first `top_n` ranks, else NULL; a NULL name gives NULL."""
    before, between, after = (F.lit(p) for p in parts)
    return F.when(rank <= top_n, F.concat(before, name, between, rank.cast("string"), after))
