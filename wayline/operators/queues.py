"""Pending-work queues and their outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayline import constants as K
from wayline.operators.ordering import before_first, distributed_row_number


def ordered_limit(df: DataFrame, order_by: Sequence[Column], limit: int) -> DataFrame:
    """The first `limit` rows: each task keeps its own best, then one merge."""
    return df.orderBy(*order_by).limit(limit)


def pending_queue(state: DataFrame, flag: str, key: str = "content_id", limit: int | None = K.DETAIL_BATCH_LIMIT) -> DataFrame:
    """Ids whose flag is set: the first `limit` in id order, or all of them."""
    due = state.where(F.col(flag)).select(key)
    return due if limit is None else ordered_limit(due, [F.col(key)], limit)


def ready_filter(
    state: DataFrame,
    pending: str = "embed_pending",
    cleared: Sequence[str] = ("detail_common_pending", "detail_intro_pending", "detail_info_pending"),
) -> DataFrame:
    """Work is due and every listed preparation is done."""
    done = reduce(lambda a, b: a & b, [~F.col(c) for c in cleared])
    return state.where(F.col(pending) & done)


def ready_queue(state: DataFrame, key: str = "content_id", limit: int | None = K.NOTIFY_LIMIT, **flags) -> DataFrame:
    """Ready ids: the first `limit` in id order, or all of them."""
    due = ready_filter(state, **flags).select(key)
    return due if limit is None else ordered_limit(due, [F.col(key)], limit)


def missing_children(
    parents: DataFrame, state: DataFrame, children: DataFrame, key: str = "content_id",
    absent: str = "image_absent", limit: int | None = K.IMAGE_RECOVERY_LIMIT,
) -> DataFrame:
    """Parents without a child that are not known to have none at the source.

    All three are whole tables, so none is broadcast on an estimate.
    """
    open_ids = state.where(~F.col(absent)).select(key)
    due = parents.select(key).hint("merge").join(open_ids, key, "left_semi")
    due = due.hint("merge").join(children.select(key).distinct(), key, "left_anti")
    return due if limit is None else ordered_limit(due, [F.col(key)], limit)


STOP_STATUSES = ("quota", "rate_limit")
DONE_STATUSES = ("ok", "nodata")


def stop_at_first_failure(responses: DataFrame, queue: Sequence[str], position: str, status: str = "status") -> DataFrame:
    """Outcome per queued item, in queue order.

    Up to the first exhausted quota an item is done (`ok`, `nodata`) or failed
    (it stays pending); from there on everything stays pending untouched.
    """
    reached = before_first(responses, queue, position, responses.where(F.col(status).isin(*STOP_STATUSES)))
    outcome = F.when(F.col(status).isin(*DONE_STATUSES), F.lit("done")).otherwise(F.lit("failed"))
    return reached.withColumn("outcome", outcome)


def outbox_batches(
    ids: DataFrame, run_id: str, key: str = "content_id", limit: int | None = K.NOTIFY_LIMIT,
    batch_size: int = K.NOTIFY_BATCH,
) -> DataFrame:
    """Ready ids in id order as messages of at most `batch_size` ids each."""
    if limit is not None:
        ids = ordered_limit(ids.select(key), [F.col(key)], limit)
    numbered = distributed_row_number(ids.select(key), [], [F.col(key)], "_rn")
    batches = (
        numbered.withColumn("batch_no", F.floor((F.col("_rn") - 1) / batch_size))
        .groupBy("batch_no")
        .agg(F.array_sort(F.collect_list(key)).alias("_ids"))
    )
    message = F.to_json(F.struct(F.lit(run_id).alias("runId"), F.col("_ids").alias("contentIds")))
    return batches.select("batch_no", F.size("_ids").cast("bigint").alias("n_ids"), message.alias("message"))
