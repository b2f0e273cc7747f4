"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayline.sources import files


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "wayline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC wall-clock time; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Stream state that outgrows executor memory stays on disk.
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def union_rows(first: DataFrame, *others: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Rows of all frames, matched by column name.

    Spark 4.1 lets a union of equally partitioned inputs pass as partitioned
    itself. Under adaptive execution the inputs may be read differently, and an
    aggregate or join planned on that claim then sees one key twice. The
    setting is turned off for the session wherever rows are united.
    """
    first.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), others, first)


def constant_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A fixed list as a frame whose size the optimizer can see.

    A frame made from Python objects has no size estimate and would be
    shuffled; this one is a projection of one row, small enough by its own
    estimate to be broadcast.
    """
    entries = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a temporary folder,
    remembered in the session so that later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = spark.conf.get("wayline.local.root", None)
    if not root:
        root = tempfile.mkdtemp(prefix="wayline-")
        spark.conf.set("wayline.local.root", root)
    return root


def _scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/wayline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path in this application's part of the shared root."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application stored in between; call it when its results are written."""
    files.delete(spark, _scratch(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the stored rows.

    Used where one result feeds several branches that must agree, or where a
    long lineage should end: the files outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
