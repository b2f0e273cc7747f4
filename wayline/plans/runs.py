"""The run ledger round a job: one row per run, also of one that fails."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wayline.operators.quality import finish_runs, start_runs
from wayline.session import constant_rows, materialize
from wayline.sources.tables import Tables

RUNNING, SUCCESS, FAILED = "running", "success", "failed"


def recorded(tables: Tables, job_id: str, run_id: str, now: Column, job: Callable[[], DataFrame]) -> DataFrame:
    """Run `job` between the opening and the closing row of its run; returns its counters as stored.

    The counters (one row, or one per kind of work) become the run's statistics,
    a JSON list. They are stored when the job ends, so reading them later costs
    no second pass over its input. A run that raises is closed as failed, with
    the error's first line, and raises on; a repeated run opens its row anew.
    """
    spark = tables.spark
    run = constant_rows(spark, [(job_id, run_id)], ["dag_id", "run_id"])
    tables.write("etl_run", start_runs(tables.read("etl_run"), run, now))
    try:
        counters = materialize(job(), "counters")
    except Exception as error:
        reason = (str(error).splitlines() or [""])[0][:500]
        failed = F.to_json(F.struct(F.lit(type(error).__name__).alias("error"), F.lit(reason).alias("message")))
        _close(tables, run.select("*", F.lit(FAILED).alias("status"), failed.alias("stats")), now)
        raise
    # A handful of counters.
    stats = counters.agg(F.to_json(F.array_sort(F.collect_list(F.struct("*")))).alias("stats")).first()["stats"]
    _close(tables, run.select("*", F.lit(SUCCESS).alias("status"), F.lit(stats).alias("stats")), now)
    return counters


def _close(tables: Tables, result: DataFrame, now: Column) -> None:
    tables.write("etl_run", finish_runs(tables.read("etl_run"), result, now))
    tables.expire("etl_run", keep=4)


def run_name(tables: Tables, now: Column) -> str:
    """A run's name where its caller gives none: the time it is valued at."""
    return tables.spark.range(1).select(now.cast("string")).first()[0]
