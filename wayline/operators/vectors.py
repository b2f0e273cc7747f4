"""Embedding text and nearest items."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wayline import constants as K
from wayline.operators.ordering import top_n_per_group
from wayline.session import union_rows


def embedding_input(parts: Sequence[Column], labels: Sequence[str] = K.EMBEDDING_LABELS) -> Column:
    """`label: value` lines in fixed order; a missing value leaves its line empty."""
    lines = [F.concat(F.lit(f"{label}: "), F.coalesce(c.cast("string"), F.lit(""))) for label, c in zip(labels, parts)]
    return F.concat_ws(K.EMBEDDING_SEPARATOR, *lines)


def vector_id(key: Column, version: str, prefix: str = "place") -> Column:
    """The same id for the same entity and embedding version, run after run."""
    return F.concat(F.lit(f"{prefix}:"), key.cast("string"), F.lit(f":{version}"))


#: Items that a task holds at once, and queries compared with them at once.
SHARD_ITEMS, QUERY_ROWS = 32_768, 64


def cosine_top_k(
    items: DataFrame, queries: DataFrame, k: int, item_id: str, query_id: str, vector: str = "embedding",
) -> DataFrame:
    """The `k` most similar items for each query vector; neither side is bounded.

    Items go to shards of a fixed size; the queries follow every shard's items
    in the task's stream, in blocks. A block and a shard make one matrix
    product that leaves the best `k` per query, so the shuffle carries those,
    not the pairs. Null vectors take no part.
    """
    # Nested so that workers need nothing but numpy and pandas.
    def unit(rows: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        return rows / np.where(norms == 0, 1.0, norms)

    def best(block: pd.DataFrame, ids: np.ndarray, matrix: np.ndarray) -> pd.DataFrame:
        scores = unit(np.stack(block["vector"].to_numpy()).astype("float64")) @ matrix.T
        n = min(k, len(ids))
        floors = np.partition(scores, -n, axis=1)[:, -n]
        rows, columns = np.nonzero(scores >= floors[:, None])
        order = np.lexsort((ids[columns], -scores[rows, columns], rows))
        rows, columns = rows[order], columns[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)  # ties at the border beyond n go
        rows, columns = rows[place < n], columns[place < n]
        names = block["query_id"].to_numpy()[rows]
        return pd.DataFrame({"query_id": names, "item_id": ids[columns], "similarity": scores[rows, columns]})

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, matrix, ids = None, [], None, None
        for batch in batches:
            for shard, rows in batch.groupby("shard", sort=True):
                if shard != at:
                    at, parts, matrix = shard, [], None
                own = rows[~rows["asks"]]
                if len(own):
                    parts.append((own["item_id"].to_numpy(), unit(np.stack(own["vector"].to_numpy()).astype("float64"))))
                asking = rows[rows["asks"]]
                if len(asking) and parts and matrix is None:
                    ids, matrix = (np.concatenate(c) for c in zip(*parts))
                for start in range(0, len(asking) if matrix is not None else 0, QUERY_ROWS):
                    yield best(asking.iloc[start : start + QUERY_ROWS], ids, matrix)

    id_type = lambda df, c: df.schema[c].dataType.simpleString()
    kinds = {"item_id": id_type(items, item_id), "query_id": id_type(queries, query_id)}
    known = items.where(F.col(vector).isNotNull())
    shards = known.agg(F.greatest(F.ceil(F.count("*") / SHARD_ITEMS), F.lit(1)).cast("int")).scalar()
    held = known.select(
        F.col(item_id).alias("item_id"), F.lit(None).cast(kinds["query_id"]).alias("query_id"), F.col(vector).alias("vector"),
        F.lit(False).alias("asks"), F.pmod(F.xxhash64(item_id), shards).cast("int").alias("shard"),
    )
    asked = queries.where(F.col(vector).isNotNull()).select(
        F.lit(None).cast(kinds["item_id"]).alias("item_id"), F.col(query_id).alias("query_id"), F.col(vector).alias("vector"),
        F.lit(True).alias("asks"), shards.alias("_shards"),
    )
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1))).drop("_shards")
    placed = union_rows(held, asked).repartition("shard").sortWithinPartitions("shard", "asks")
    partial = placed.mapInPandas(nearest, f"query_id {kinds['query_id']}, item_id {kinds['item_id']}, similarity double")
    return top_n_per_group(
        partial, ["query_id"], [F.col("similarity").desc(), F.col("item_id").asc()], k, rank="rank"
    )
