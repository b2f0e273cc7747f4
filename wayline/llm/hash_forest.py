"""Nearest neighbours by a forest of sorted long hash strings."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayline.llm.shards import merge_top, search_shards

#: Trees in a forest, bits of a hash string, and vectors in a shard.
TREES, BITS, SHARD_ROWS = 32, 64, 8192
#: A query ascends until it has met this share of a shard; on vectors without structure recall follows it closely.
CANDIDATE_SHARE = 0.45
#: So many square roots of the shard's size are added, which matters where a shard is small.
ROOM = 6.0


def usable(vector: Column) -> Column:
    """Not null, not zero, every component finite."""
    values = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(values, lambda x: x != 0)


class Forest:
    """One shard: its vectors and, per tree, their hash strings in order."""

    def __init__(self, seed: int, trees: int, share: float):
        self.seed, self.trees, self.share = seed, trees, share
        self.ids: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.keys: list[np.ndarray] | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(vectors)

    def _hash(self, vectors: np.ndarray) -> np.ndarray:
        """Signs of random projections, one 64-bit string per vector and tree."""
        signs = ((vectors - self.middle) @ self.planes > 0).reshape(len(vectors), self.trees, BITS)
        return np.packbits(signs, axis=2).view(">u8")[:, :, 0].astype(np.uint64)

    def build(self) -> None:
        self.vectors, self.names = np.concatenate(self.rows), np.concatenate(self.ids)
        self.rows, self.ids = [], []
        self.squares = (self.vectors**2).sum(axis=1)
        self.middle = self.vectors.mean(axis=0)
        self.planes = np.random.default_rng(self.seed).standard_normal((self.vectors.shape[1], self.trees * BITS))
        strings = self._hash(self.vectors)
        self.order = [np.argsort(strings[:, t], kind="stable") for t in range(self.trees)]
        self.keys = [strings[o, t] for t, o in enumerate(self.order)]

    def runs(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query, prefix length (0 to BITS) and tree: where the run of rows with that common prefix begins and ends."""
        bits = np.arange(BITS + 1, dtype=np.uint64)
        free = np.where(bits == 0, np.uint64((1 << 64) - 1), (np.uint64(1) << (np.uint64(BITS) - np.maximum(bits, np.uint64(1)))) - np.uint64(1))
        begin = np.empty((len(strings), BITS + 1, self.trees), np.int64)
        end = np.empty_like(begin)
        for t, keys in enumerate(self.keys):
            begin[:, :, t] = np.searchsorted(keys, strings[:, t, None] & ~free, "left")
            end[:, :, t] = np.searchsorted(keys, strings[:, t, None] | free, "right")
        return begin, end

    def candidates(self, begin: np.ndarray, end: np.ndarray, wanted: int) -> np.ndarray:
        """Rows that share the longest prefixes with the query's strings, at least `wanted` of them.

        All trees descend to their longest match, then give up one bit at a
        time together; the rows with a common prefix stand in one run.
        """
        wanted = min(wanted, len(self.names))
        met = np.zeros(len(self.names), bool)
        enough = np.flatnonzero((end - begin).sum(axis=1) >= wanted)
        for bits in range(enough[-1], -1, -1):
            for order, a, b in zip(self.order, begin[bits].tolist(), end[bits].tolist()):
                met[order[a:b]] = True
            if np.count_nonzero(met) >= wanted:
                break
        return np.flatnonzero(met)

    def nearest(self, query_ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and distances of each query's nearest candidates."""
        begin, end = self.runs(self._hash(vectors))
        n = len(self.names)
        wanted = max(4 * k, ceil(self.share * n + ROOM * n**0.5))
        # Squared distances of all at once, up to rounding: they choose which candidates are measured exactly.
        sizes = (vectors**2).sum(axis=1)
        rough = self.squares[:, None] - 2 * (self.vectors @ vectors.T) + sizes
        found = []
        for i, query_id in enumerate(query_ids):
            rows = self.candidates(begin[i], end[i], wanted)
            rows = rows[self.names[rows] != query_id]
            near = rough[rows, i]
            if len(rows) > k and np.isfinite(near).all():  # squares of huge components overflow
                slack = 1e-9 * (self.squares.max() + sizes[i])
                rows = rows[near <= np.partition(near, k - 1)[k - 1] + slack]
            far = np.sqrt(((self.vectors[rows] - vectors[i]) ** 2).sum(axis=1))
            best = np.lexsort((self.names[rows], far))[:k]
            found.append((self.names[rows][best], far[best]))
        return found


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, share: float = CANDIDATE_SHARE, shard_rows: int = SHARD_ROWS, seed: int = 3,
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: each query's k nearest by Euclidean distance among the candidates found.

    Every usable vector is indexed, in shards of about `shard_rows`; each
    shard is searched with the same share of candidates and the answers are
    merged, so recall does not depend on the size. Ties go to the smaller id.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows with a null id. A row is not found by a query of its own
    id; an id queried twice is answered once, for its smallest vector. Vectors
    of another length than the query's are not compared. Empty tables give an
    empty result; further columns are ignored, whatever their names.
    """
    doubles = lambda df: df.select(
        df[id_col].cast("long").alias("id"), F.transform(df[vector_col], lambda x: x.cast("double")).alias("vector")
    ).filter(usable(F.col("vector")) & F.col("id").isNotNull())
    rows, asked = doubles(vectors), doubles(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    lengths = [(r["n"], r["count"]) for r in rows.groupBy(F.size("vector").alias("n")).count().collect()]
    result = "query_id long, found_id long, score double"
    schema = pa.schema([("query_id", pa.int64()), ("found_id", pa.int64()), ("score", pa.float64())])

    def start() -> Forest:
        return Forest(seed, trees, share)

    def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        flat = batch.column(3).flatten().to_numpy()
        return batch.column(2).to_numpy(), flat.reshape(batch.num_rows, -1)

    def add(index: Forest, batch: pa.RecordBatch) -> None:
        index.add(*unpack(batch))

    def search(index: Forest, batch: pa.RecordBatch) -> pa.RecordBatch:
        if not index.ids and index.keys is None:
            return pa.RecordBatch.from_pylist([], schema)
        if index.keys is None:
            index.build()
        ids, asked_vectors = unpack(batch)
        found = [(i, *best) for i, best in zip(ids, index.nearest(ids, asked_vectors, k))]
        asked_ids = np.repeat([i for i, _, _ in found], [len(n) for _, n, _ in found]).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(asked_ids), pa.array(np.concatenate([n for _, n, _ in found])), pa.array(np.concatenate([d for _, _, d in found])),
        ], schema=schema)

    parts = []
    for n, count in lengths:
        n_shards = ceil(count / shard_rows)
        mine = rows.filter(F.size("vector") == n).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)))
        parts.append(search_shards(mine, asked.filter(F.size("vector") == n), n_shards, add, search, start, result))
    if not parts:
        found = vectors.sparkSession.createDataFrame([], result)
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.union(part)
    return merge_top(found, k, F.col("score").asc()).select("query_id", "rank", F.col("found_id").alias("vec_id"), "score")
