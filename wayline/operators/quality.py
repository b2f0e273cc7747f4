"""Declared constraints as checks, stage counters, the run ledger and code trees."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayline.operators.merge import merge_upsert, update_from
from wayline.session import union_rows


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def _count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def check_domain(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule in one pass; like a constraint, NULL passes."""
    counts = df.agg(*[_count_when(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.inline(pairs))


def check_exclusive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that do not have exactly one of the columns set."""
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    return df.where(filled != 1)


def check_orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose key is set but has no parent."""
    known = parents.select(F.col(parent_key).alias(child_key)).distinct()
    return children.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti").select(*children.columns)


def stage_stats(df: DataFrame, counters: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Conditional counts of a stage in one aggregation."""
    return df.groupBy(*by).agg(*[_count_when(c).alias(name) for name, c in counters.items()])


def start_runs(ledger: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """New runs enter as running; a known one is reset to running, its stats kept."""
    return merge_upsert(
        ledger,
        runs.select("dag_id", "run_id"),
        ["dag_id", "run_id"],
        update=[],
        insert_defaults={"status": F.lit("running"), "started_at": now},
        set_on_match={"status": F.lit("running"), "started_at": now, "finished_at": F.lit(None)},
    )


def finish_runs(ledger: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Status, end time and stats of finished runs; unknown runs change nothing."""
    return update_from(ledger, results, ["dag_id", "run_id"], ["status", "stats"], {"finished_at": now})


def run_results(stages: DataFrame, status: str = "status") -> DataFrame:
    """Per run: failed when any stage failed, and all stage statistics as one JSON object.

    A run has a fixed handful of stages, so its map is small.
    """
    failed = F.max(F.when(F.col(status) == "failed", 1).otherwise(0))
    packed = F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "processed"))))
    return stages.groupBy("dag_id", "run_id").agg(
        F.when(failed == 1, "failed").otherwise("success").alias("status"), F.to_json(packed).alias("stats")
    )


def parent_code(level1: Column, level2: Column) -> Column:
    """Parent of a code listed under a level-2 code, else under a level-1 code."""
    return F.coalesce(level2, level1)


def category_tree(codes: DataFrame) -> DataFrame:
    """Codes with the name path from their level-1 ancestor; broken branches drop out.

    `codes`: code, name, depth, parent_code.
    """
    level = lambda d, p: codes.where(F.col("depth") == d).select(
        F.col("code").alias(f"{p}_code"), F.col("name").alias(f"{p}_name"), F.col("parent_code").alias(f"{p}_parent")
    )
    top, mid, low = level(1, "a"), level(2, "b"), level(3, "c")
    two = mid.join(top, F.col("b_parent") == F.col("a_code"))
    three = low.join(two, F.col("c_parent") == F.col("b_code"))
    path = lambda *names: F.concat_ws(" > ", *names).alias("path")
    row = lambda df, code, depth, *names: df.select(
        F.col(code).alias("code"), F.lit(depth).alias("depth"), F.col("a_code").alias("root"), path(*names)
    )
    return union_rows(
        row(top, "a_code", 1, "a_name"),
        row(two, "b_code", 2, "a_name", "b_name"),
        row(three, "c_code", 3, "a_name", "b_name", "c_name"),
    )


def bootstrap_needed(wanted: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Per wanted region: true when the code table has no row for it."""
    have = codes.select(F.col(key).alias("_have")).distinct()
    return wanted.select(key).distinct().join(have, F.col(key) == F.col("_have"), "left").select(
        key, F.col("_have").isNull().alias("needed")
    )
