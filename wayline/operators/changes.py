"""Duplicates and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayline.operators.ordering import first_per_group


def dedup_last_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order_by`."""
    return first_per_group(df, keys, [F.col(c).desc() for c in order_by])


def priority_dedup(df: DataFrame, parent: str, priority: Column, order_by: Sequence[Column]) -> DataFrame:
    """One row per parent by priority number, then by `order_by`."""
    return first_per_group(df, [parent], [priority.asc(), *order_by])


def source_priority(source: Column, ranked: Sequence[str]) -> Column:
    """Position of a source in the ranking; unlisted sources come last."""
    return F.coalesce(*[F.when(source == name, F.lit(i)) for i, name in enumerate(ranked)], F.lit(len(ranked)))


def known_hashes(state: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """State rows whose business row exists too, so that lost rows load again."""
    return state.hint("merge").join(target.select(key).distinct(), key, "left_semi")


def detect_changes(source: DataFrame, state: DataFrame, target: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Source rows that are new or whose hash differs from the stored one.

    All sides are whole tables, so none is broadcast on an estimate.
    """
    known = known_hashes(state, target, key).select(F.col(key).alias("_key"), F.col(hash_col).alias("_hash"))
    return (
        source.hint("merge").join(known, F.col(key) == F.col("_key"), "left")
        .where(~F.col(hash_col).eqNullSafe(F.col("_hash")))
        .select(*source.columns)
    )


def change_reasons(
    source: DataFrame, state: DataFrame, key: str, hash_col: str,
    updated: str, collected: str, versions: Sequence[str] = (),
) -> DataFrame:
    """Changed rows with every reason: new, newer at the source, other content, other rule version."""
    stored = state.select(
        F.col(key).alias("_key"),
        F.col(hash_col).alias("_hash"),
        F.col(collected).alias("_collected"),
        *[F.col(v).alias(f"_{v}") for v in versions],
    )
    known = F.col("_key").isNotNull()
    checks = [
        F.when(~known, F.lit("new")),
        F.when(known & (F.col(updated) > F.col("_collected")), F.lit("updated")),
        F.when(known & ~F.col(hash_col).eqNullSafe(F.col("_hash")), F.lit("content")),
        *[F.when(known & ~F.col(v).eqNullSafe(F.col(f"_{v}")), F.lit(v)) for v in versions],
    ]
    return (
        source.join(stored, F.col(key) == F.col("_key"), "left")
        .withColumn("reasons", F.array_compact(F.array(*checks)))
        .where(F.size("reasons") > 0)
        .select(*source.columns, "reasons")
    )
