"""Exact BM25 top-k search: sharded inverted indexes, bounds of all documents, floors from the first shards."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wayline.llm.common import record, small_batches, texts_as_bytes, two_columns, word_slices
from wayline.llm.shards import merge_top, search_shards
from wayline.session import materialize, union_rows

K1, B = 1.2, 0.75
#: Words in a shard's texts, queries in a block, and the list length from which a list may be a row of the matrix.
SHARD_WORDS, BLOCK, LONG_LIST = 8_000_000, 256, 256
#: Size of a shard's matrix of long lists, and texts scored exactly at once.
_MATRIX_BYTES, _SCORED = 64 << 20, 256
_FLUSH = 1 << 22
_FILTER_BITS = 1 << 23
# A word is a run of letters and digits of ASCII or of bytes beyond it, A-Z lower-cased.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def term_codes(text: bytes) -> np.ndarray:
    """64-bit codes of all words of a text."""
    parts = [np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)) for w in (p.translate(_PLAIN).split() for p in word_slices(text))]
    return np.concatenate(parts)


def _places(codes: np.ndarray) -> list[np.ndarray]:
    return [(codes >> np.uint64(s)) & np.uint64(_FILTER_BITS - 1) for s in (0, 23, 41)]


def _asked(codes: np.ndarray, field: np.ndarray) -> np.ndarray:
    """The codes that may be terms of some query: a filter of fixed size leaves out most others."""
    a, b, c = (field[p] for p in _places(codes))
    return codes[a & b & c]


class Index:
    """One shard's inverted lists; texts are numbered in order of arrival, copies of a text are one."""

    def __init__(self, average: float, field: np.ndarray):
        self.average, self.field = average, field
        self.ids: list[list[int]] = []
        self.seen: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.codes: np.ndarray | None = None

    def add(self, id_: int, text: bytes) -> None:
        at = self.seen.setdefault(xxhash.xxh3_128_digest(text), len(self.ids))
        if at < len(self.ids):
            self.ids[at].append(id_)
            return
        codes = term_codes(text)
        terms, times = np.unique(_asked(codes, self.field), return_counts=True)
        norm = K1 * (1 - B + B * len(codes) / self.average)
        self.parts.append((terms, (times * (K1 + 1) / (times + norm)).astype(np.float64)))
        self.ids.append([id_])

    def build(self) -> None:
        sizes = [len(t) for t, _ in self.parts]
        codes = np.concatenate([t for t, _ in self.parts])
        # By text, for exact scores of a few; by term, in single precision, for bounds of all.
        self.text_impacts = np.concatenate([i for _, i in self.parts])
        self.text_starts = np.append(0, np.cumsum(sizes))
        self.parts, self.seen = [], {}
        n = len(self.ids)
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        new = np.diff(codes, prepend=codes[:1] ^ np.uint64(1)) != 0 if len(codes) else np.empty(0, bool)
        first = np.flatnonzero(new)
        self.codes, self.starts = codes[first], np.append(first, len(codes))
        self.text_terms = np.empty(len(codes), np.int32)
        self.text_terms[order] = np.cumsum(new) - 1
        self.texts = np.repeat(np.arange(n, dtype=np.int32), sizes)[order]
        self.impacts = self.text_impacts[order].astype(np.float32)
        self.first_ids = np.array([min(i) for i in self.ids], np.int64)
        self.weight = np.zeros(len(self.codes))
        lengths = np.diff(self.starts)
        long = np.flatnonzero(lengths >= max(LONG_LIST, n / 16))
        long = long[np.argsort(-lengths[long], kind="stable")][: _MATRIX_BYTES // (4 * n)]
        self.long_at = np.full(len(self.codes), -1, np.int32)
        self.long_at[long] = np.arange(len(long))
        self.long = np.zeros((len(long), n), np.float32)
        for row, t in zip(self.long, long):
            a, b = self.starts[t], self.starts[t + 1]
            row[self.texts[a:b]] = self.impacts[a:b]

    def top(self, asked: list[tuple[np.ndarray, np.ndarray, float]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the k best documents of every query: its terms, their weights, its floor.

        Long lists are rows of a matrix and added up for a block of queries at
        once, short ones query by query. These sums are in single precision and
        bound a score within their rounding error. Only texts whose bound
        reaches the floor, or the k-th best sum, are scored exactly, in the
        order of their terms, so that equal texts have equal scores in every
        shard. Documents below a floor may be left out.
        """
        found = []
        step = max(1, min(BLOCK, _MATRIX_BYTES // (16 * len(self.ids))))
        for start in range(0, len(asked), step):
            block = [(*self._known(codes, weights), floor) for codes, weights, floor in asked[start : start + step]]
            wanted = np.zeros((len(block), len(self.long)), np.float32)
            for row, (terms, weights, _) in zip(wanted, block):
                at = self.long_at[terms]
                row[at[at >= 0]] = weights[at >= 0]
            for sums, (terms, weights, floor) in zip(wanted @ self.long, block):
                found.append(self._best(sums, terms, weights, floor, k))
        return found

    def _known(self, codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.codes):
            return np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        return at[hit], weights[hit]

    def _best(self, sums: np.ndarray, terms: np.ndarray, weights: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        short = self.long_at[terms] < 0
        at, sizes = _ranges(self.starts, terms[short])
        if len(at):
            sums = sums + np.bincount(self.texts[at], self.impacts[at] * np.repeat(weights[short], sizes), len(sums))
        # More than the rounding error of a sum of so many terms, and than that of rounded floors.
        error = (len(terms) + 16) * 2.0**-23
        rows = np.flatnonzero(sums > max(floor * (1 - error) - 2e-9, 0.0))
        if len(rows) > k:
            reached = sums[rows]
            kth = np.partition(reached, -k)[-k] * (1 - error)
            rows = rows[reached > kth * (1 - error) - 2e-9]
        scores = np.zeros(len(rows))
        self.weight[terms] = weights
        for start in range(0, len(rows), _SCORED):
            at, sizes = _ranges(self.text_starts, rows[start : start + _SCORED])
            parts = self.text_impacts[at] * self.weight[self.text_terms[at]]
            scores[start : start + _SCORED] = np.bincount(np.repeat(np.arange(len(sizes)), sizes), parts, len(sizes))
        self.weight[terms] = 0.0
        scores = np.round(scores, 9)
        best = np.lexsort((self.first_ids[rows], -scores))[:k]
        best = best[scores[best] >= floor]
        copies = [sorted(self.ids[r])[:k] for r in rows[best]]
        names = np.array([i for c in copies for i in c], np.int64)
        scores = np.repeat(scores[best], [len(c) for c in copies])
        best = np.lexsort((names, -scores))[:k]
        return names[best], scores[best]


def _ranges(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the given lists, one list after the other, and the lists' lengths."""
    sizes = starts[which + 1] - starts[which]
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts[which] - before, sizes), sizes


def _filter_of(terms: DataFrame) -> np.ndarray:
    """A bit field of fixed size with all query terms marked; tasks mark their own, the marks are joined."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(_FILTER_BITS, bool)
        for batch in batches:
            for p in _places(batch.column(0).to_numpy().view(np.uint64)):
                field[p] = True
        words = np.packbits(field).view(">i8").astype(np.int64)
        at = np.flatnonzero(words)
        yield record(pa.schema([("word", pa.int32()), ("mask", pa.int64())]), (at, words[at]))

    words = np.zeros(_FILTER_BITS // 64, np.int64)
    for r in terms.select("term").mapInArrow(marks, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).collect():
        words[r["word"]] = r["mask"]
    return words.astype(">i8").view(np.uint8)


def _query_terms(queries: DataFrame) -> DataFrame:
    """`query_id`, `term`: the distinct words of every query."""
    schema = pa.schema([("query_id", pa.int64()), ("term", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for id_, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                terms = np.unique(term_codes(text)).view(np.int64)
                yield record(schema, (np.full(len(terms), id_), terms))

    return queries.mapInArrow(run, "query_id long, term long").distinct()


def _frequencies(rows: DataFrame, field: np.ndarray) -> DataFrame:
    """`term`, `df` over all texts for terms of queries; the row of the null term holds the number of words."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(field).view(bool)
        held, size, words = [], 0, 0
        for batch in small_batches(batches):
            for text in texts_as_bytes(batch.column(1)):
                codes = term_codes(text)
                words += len(codes)
                held.append(np.unique(_asked(codes, known)))
                size += len(held[-1])
            if size >= _FLUSH:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)
        yield record(schema, ([None], [words]))

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        terms, times = np.unique(np.concatenate(held), return_counts=True)
        return record(schema, (terms.view(np.int64), times))

    return rows.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`query_id`, `rank`, `doc_id`, `score`: the k best documents of every query, exactly.

    A query is the set of its text's distinct words. Scores are BM25 with
    statistics over all documents, rounded to nine decimals; ties go to the
    smaller id, and only documents that share a word are found. Every document
    is indexed, in shards of about `SHARD_WORDS` words; a query meets every
    shard, its own document included.

    Null texts are empty: they find nothing and are not found, but count as
    documents. Rows with a null id take no part. Repeated documents are each
    found; a query id that occurs twice is asked once, with the words of both.
    Further columns are ignored; empty tables give empty results.
    """
    spark = docs.sparkSession
    rows = two_columns(docs, id_col, text_col).filter("id IS NOT NULL")
    asked = materialize(_query_terms(two_columns(queries, id_col, text_col).filter("id IS NOT NULL")), "search-terms")
    field = _filter_of(asked)
    stats = materialize(_frequencies(rows, field), "search-stats")
    n_docs = rows.count()
    n_words = stats.filter("term IS NULL").agg(F.sum("df")).first()[0] or 0
    result = "query_id long, found_id long, score double"
    if not n_words:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    average = n_words / n_docs
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = materialize(asked.join(stats.filter("term IS NOT NULL").select("term", idf.alias("idf")), "term").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("term", "idf"))).alias("t")
    ).select(F.col("query_id").alias("id"), F.col("t.term").alias("terms"), F.col("t.idf").alias("idf"), F.lit(None).cast("string").alias("text")), "search-queries")
    schema = pa.schema([("query_id", pa.int64()), ("found_id", pa.int64()), ("score", pa.float64())])

    def start() -> Index:
        return Index(average, np.unpackbits(field).view(bool))

    def add(index: Index, batch: pa.RecordBatch) -> None:
        for id_, text in zip(batch.column(2).to_pylist(), texts_as_bytes(batch.column(5))):
            index.add(id_, text)

    def find(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        if not index.ids:
            return pa.RecordBatch.from_pylist([], schema)
        if index.codes is None:
            index.build()
        ids, *asked = (batch.column(c).to_pylist() for c in (2, 3, 4, 6))
        asked = [(np.array(terms, np.int64).view(np.uint64), np.array(idf_), floor or 0.0) for terms, idf_, floor in zip(*asked)]
        found = index.top(asked, k)
        sizes = [len(names) for names, _ in found]
        return record(schema, (np.repeat(np.array(ids, np.int64), sizes), *map(np.concatenate, zip(*found))))

    n_shards = ceil(n_words / SHARD_WORDS)
    texts = rows.select("id", F.lit(None).cast("array<long>").alias("terms"), F.lit(None).cast("array<double>").alias("idf"), "text",
                        F.lit(None).cast("double").alias("floor"), F.pmod(F.xxhash64("id"), F.lit(n_shards)).alias("shard"))
    # The k-th best score of some shards is a floor for all others, which then send little.
    first = ceil(sqrt(n_shards))
    found = search_shards(texts.filter(F.col("shard") < first), weighed.withColumn("floor", F.lit(0.0)), first, add, find, start, result)
    best = merge_top(found, k, F.col("score").desc())
    if first < n_shards:
        best = materialize(best, "search-first")
        floors = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        others = texts.filter(F.col("shard") >= first).withColumn("shard", F.col("shard") - first)
        found = search_shards(others, weighed.join(floors, "id", "left"), n_shards - first, add, find, start, result)
        best = merge_top(union_rows(best.drop("rank"), found), k, F.col("score").desc())
    return best.select("query_id", "rank", F.col("found_id").alias("doc_id"), "score")
