"""Searches that run on one shard of the rows after another: first a shard's rows, then the queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayline.llm.common import small_batches


def search_shards(
    rows: DataFrame, queries: DataFrame, n_shards: int, add: Callable, search: Callable, start: Callable, result: str
) -> DataFrame:
    """Every query on every shard: `start()` an empty index, `add(index, batch)` its rows, `search(index, batch)`.

    `rows` and `queries` have the same columns; `rows` also has `shard`. A
    query goes to each shard once, in blocks that follow the shard's rows in
    the task's stream, so a task holds one shard's index and one block.
    """
    sent = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).withColumn("kind", F.lit(1))
    both = rows.withColumn("shard", F.col("shard").cast("int")).withColumn("kind", F.lit(0)).unionByName(sent)
    columns = ["shard", "kind", *queries.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        for batch in small_batches(batches, 512):
            for part in _runs(batch):
                shard, kind = part.column(0)[0].as_py(), part.column(1)[0].as_py()
                if shard != at:
                    at, index = shard, start()
                if kind == 0:
                    add(index, part)
                else:
                    yield search(index, part)

    placed = both.select(*columns).repartitionById(n_shards, F.col("shard"))
    return placed.sortWithinPartitions("shard", "kind").mapInArrow(run, result)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with one shard and one kind each."""
    keys = [a * 2 + b for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    start = 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[start]:
            yield batch.slice(start, k - start)
            start = k


def merge_top(found: DataFrame, k: int, best_first: F.Column) -> DataFrame:
    """The k best of every query over all shards, ties to the smaller id: adds `rank` from 1."""
    order = Window.partitionBy("query_id").orderBy(best_first, "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
