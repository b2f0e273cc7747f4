"""Keyed writes as joins: upsert, update, insert-ignore, replace, delete.

Every operator takes the stored rows and the change rows and returns the new
rows; `sources.tables` publishes them. Change rows must be unique per key
(use `dedup_last_wins` first). The stored side is joined with a left or anti
join, so a small change set is broadcast by the optimizer's own size check and
the stored rows are not shuffled; a large one falls back to a shuffled join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayline.session import union_rows


def _on(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    set_on_match: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Overwrite `update` columns of matching keys; never inserts.

    A matched NULL overwrites. `set_on_match` holds expressions over `t.` and
    `s.` columns, evaluated for matching keys only.
    """
    exprs = {c: F.col(f"s.{c}") for c in update} | dict(set_on_match or {})
    hit = F.col("s._hit").isNotNull()
    columns = []
    for field in target.schema.fields:
        old = F.col(f"t.{field.name}")
        new = exprs.get(field.name)
        columns.append(old if new is None else F.when(hit, new.cast(field.dataType)).otherwise(old).alias(field.name))
    changes = source.withColumn("_hit", F.lit(True)).alias("s")
    return target.alias("t").join(changes, _on(keys), "left").select(*columns)


def new_keys_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows whose key is not stored.

    The stored keys are first cut to those the changes mention, so that a big
    table never has to be built into, or shuffled for, the anti join.
    """
    wanted = source.select(*keys).distinct()
    known = target.select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return source.join(known, list(keys), "left_anti")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert_defaults: Mapping[str, Column] | None = None,
    set_on_match: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys, overwrite `update` columns of stored ones.

    Columns not listed keep their stored value on a match and take
    `insert_defaults` (over the change columns) or NULL on insert.
    """
    if update is None:
        update = [c for c in target.columns if c in source.columns and c not in keys]
    defaults = dict(insert_defaults or {})
    fresh = []
    for field in target.schema.fields:
        if field.name in defaults:
            value = defaults[field.name]
        elif field.name in source.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        fresh.append(value.cast(field.dataType).alias(field.name))
    updated = update_from(target, source, keys, update, set_on_match)
    return union_rows(updated, new_keys_only(target, source, keys).select(*fresh))


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Rows to append: one per unseen key, the first by `order_by`.

    Duplicates are reduced by an aggregate with map-side combine before the
    join, so a group of copies of any size crosses the shuffle as a few rows.
    """
    if order_by:
        order = F.struct(*order_by)
        rest = [c for c in source.columns if c not in keys]
        packed = source.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
        unique = packed.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns])
    else:
        unique = source.dropDuplicates(list(keys))
    return new_keys_only(target, unique, keys)


def state_upsert(state: DataFrame, changed: DataFrame, now: Column) -> DataFrame:
    """Store the new hash and re-arm the work flags of changed entities.

    The image flags follow the listing's own image; `last_etl_at` is set only
    for entities that were already known.
    """
    rows = changed.select(
        "content_id",
        "content_hash",
        F.col("first_image").isNotNull().alias("image_pending"),
        F.col("first_image").isNull().alias("image_absent"),
    )
    rearmed = ("detail_common_pending", "detail_intro_pending", "detail_info_pending", "embed_pending")
    return merge_upsert(
        state,
        rows,
        ["content_id"],
        update=["content_hash", "image_pending", "image_absent"],
        insert_defaults={flag: F.lit(True) for flag in rearmed},
        set_on_match={flag: F.lit(True) for flag in rearmed} | {"last_etl_at": now},
    )


def replace_children(children: DataFrame, parents: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Drop all rows of the listed parents, then add their new rows (none deletes)."""
    kept = children.join(parents.select(key).distinct(), key, "left_anti")
    return union_rows(kept, new.select(*children.columns))


def fill_if_null(target: DataFrame, source: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Take `value` from the change rows only where the stored column is NULL."""
    return update_from(
        target, source, [key], [], {column: F.coalesce(F.col(f"t.{column}"), F.col(f"s.{value}"))}
    )


def clear_flags(state: DataFrame, ids: DataFrame, key: str, flag: str, value: Column | None = None, now: Column | None = None) -> DataFrame:
    """Set `flag` of the listed ids to false, or to an expression over `s.` columns."""
    changes = {flag: F.lit(False) if value is None else value}
    if now is not None:
        changes["last_etl_at"] = now
    return update_from(state, ids, [key], [], changes)


def cascade_delete(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent remains; a NULL key goes too."""
    remaining = parents.select(F.col(parent_key).alias(child_key)).distinct()
    return children.join(remaining, child_key, "left_semi").select(*children.columns)


def set_null_on_delete(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children kept, their key emptied where the parent is gone."""
    remaining = parents.select(F.col(parent_key).alias("_parent")).distinct()
    return children.join(remaining, F.col(child_key) == F.col("_parent"), "left").select(
        *[F.col("_parent").alias(c) if c == child_key else F.col(c) for c in children.columns]
    )


def deactivate_missing(target: DataFrame, full_source: DataFrame, key: str, active: str = "active") -> DataFrame:
    """After a full sync: stored keys the source no longer has become inactive."""
    present = full_source.select(F.col(key).alias("_present")).distinct()
    return target.join(present, F.col(key) == F.col("_present"), "left").select(
        *[
            F.when(F.col("_present").isNull(), F.lit(False)).otherwise(F.col(c)).alias(c) if c == active else F.col(c)
            for c in target.columns
        ]
    )
