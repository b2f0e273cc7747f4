"""Row numbers and first-n selection that hold when one group has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayline.session import materialize


def distributed_row_number(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], out: str) -> DataFrame:
    """`row_number()` per group that never gathers a group in one task, whatever its size.

    Rows are range-partitioned by (group, order) and stored once, numbered
    inside each (slice, group), and shifted by the rows of the same group in
    earlier slices. The stored copy makes the slice borders one fact for both
    branches. Rows of equal order get different numbers, in no stated order.
    """
    keys = list(partition_by)
    sliced = df.repartitionByRange(*[F.col(k) for k in keys], *order_by).withColumn(
        "_slice", F.spark_partition_id()
    )
    stored = materialize(sliced, "row-number")

    running = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only groups that straddle a border have a shift: at most one row per slice.
    shift = (
        stored.groupBy("_slice", *keys)
        .agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.sum("_n").over(running))
        .where("_shift > 0")
        .select(F.col("_slice").alias("_s_slice"), *[F.col(k).alias(f"_s_{k}") for k in keys], "_shift")
    )
    local = Window.partitionBy("_slice", *keys).orderBy(*order_by)
    numbered = stored.withColumn("_local", F.row_number().over(local))
    same = reduce(
        lambda a, b: a & b,
        [F.col("_slice") == F.col("_s_slice")] + [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys],
    )
    return numbered.join(shift, same, "left").select(
        *df.columns, (F.col("_local") + F.coalesce("_shift", F.lit(0))).cast("bigint").alias(out)
    )


def top_n_per_group(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """First `n` rows of each group.

    For the `n` of a report every map task is cut down to `n` rows per group
    before the shuffle (Spark's rank limit), so a hot group costs no more than
    the others.
    """
    name = rank or "_rank"
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by)))
    kept = numbered.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def first_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each group."""
    return top_n_per_group(df, partition_by, order_by, 1)


def before_first(df: DataFrame, partition_by: Sequence[str], position: str, stopping: DataFrame) -> DataFrame:
    """Rows of each group placed before the group's first `stopping` row.

    The stop position is one aggregated row per group joined back, not a
    window, so no group has to fit in one task. Without group columns it is a
    single value.
    """
    keys = list(partition_by)
    if not keys:
        stop = stopping.agg(F.min(position)).scalar()
        return df.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))).select(*df.columns)
    stops = (
        stopping.groupBy(*keys)
        .agg(F.min(position).alias("_stop"))
        .select(*[F.col(k).alias(f"_s_{k}") for k in keys], "_stop")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    reached = F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))
    return df.join(stops, same, "left").where(reached).select(*df.columns)
