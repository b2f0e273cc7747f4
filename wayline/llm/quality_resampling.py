"""Quality selection by importance resampling over hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from wayline.llm.common import record, small_batches, texts_as_bytes, two_columns, word_slices
from wayline.session import materialize

#: Buckets that words and pairs of words are hashed to, and the count added to each.
BUCKETS, SMOOTHING = 10_000, 1.0
#: Share of the labelled target texts that the selection is sized to keep.
KEEP_TARGET = 0.999
#: Labelled target texts that make the target model and size the selection: a seeded sample, at most so many.
MAX_TARGETS = 20_000
#: Parts of the labelled targets; each is weighed by a target model made without it to size the selection.
FOLDS = 5
_DIGITS, _ROUNDS = 10, 6
_NO_ID = -(1 << 63)


def ngram_buckets(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word and of every pair of words of a text, A-Z lower-cased, words between ASCII blanks."""
    found, last = [], np.empty(0, np.uint64)
    for part in word_slices(text.lower()):
        words = part.split()
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        row = np.concatenate([last, codes])
        with np.errstate(over="ignore"):
            pairs = (row[:-1] * np.uint64(0x9E3779B97F4A7C15) + row[1:]) * np.uint64(0xD6E8FEB86659FD93)
        found += [codes % np.uint64(buckets), (pairs >> np.uint64(20)) % np.uint64(buckets)]
        last = row[-1:]
    return np.concatenate(found).astype(np.int64)


def _fold_of(column: pa.Array, ids: np.ndarray) -> np.ndarray:
    """Part of each id of a column, by its place in `ids`; -1 for ids that are not in it."""
    wanted = column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids, wanted, sorter=order), max(0, len(ids) - 1))
    return np.where(ids[order[at]] == wanted, order[at] % FOLDS, -1) if len(ids) else np.full(len(wanted), -1)


def _ngram_counts(docs: DataFrame, target_ids: np.ndarray, id_col: str, text_col: str, buckets: int) -> np.ndarray:
    """Counts per bucket: of all texts in row 0, then of the targets of each part.

    One scan counts for all models. A task adds up its own rows, so it sends
    at most one row per bucket; the driver gets a few counts per bucket.
    """
    names = ["raw", *(f"target{k}" for k in range(FOLDS))]
    schema = pa.schema([("bucket", pa.int32()), *((c, pa.int64()) for c in names)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 + FOLDS, buckets), np.int64)
        for batch in small_batches(batches):
            for fold, text in zip(_fold_of(batch.column(0), target_ids), texts_as_bytes(batch.column(1))):
                n = np.bincount(ngram_buckets(text, buckets), minlength=buckets)
                table[0] += n
                if fold >= 0:
                    table[1 + fold] += n
        hit = np.flatnonzero(table[0])
        if len(hit):
            yield record(schema, (hit, *table[:, hit]))

    parts = two_columns(docs, id_col, text_col).mapInArrow(count, ", ".join(["bucket int", *(f"{c} long" for c in names)]))
    table = np.zeros((1 + FOLDS, buckets), np.int64)
    for row in parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toLocalIterator():
        table[:, row["bucket"]] = row[1:]
    return table


def _ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    table = np.stack([raw, target]) + SMOOTHING
    raw, target = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
    return target - raw


def log_ratio(docs: DataFrame, target_ids: np.ndarray, id_col: str, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket log p(target) - log p(raw): raw from all texts, target from those whose id is in `target_ids`."""
    counts = _ngram_counts(docs, target_ids, id_col, text_col, buckets)
    return _ratio(counts[0], counts[1:].sum(axis=0))


def log_weights(
    docs: DataFrame, ratio: np.ndarray, id_col: str, text_col: str, keep: tuple[str, ...] = (),
    held: tuple[np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """`id`, `weight` (sum of the ratios of the text's n-grams) and the columns named in `keep`.

    With `held`, the target ids and the ratios made without each part of them,
    also `held`: the weight of a target by the ratios made without its part,
    null for other texts.
    """
    rows = docs.select(docs[text_col].alias("text"), docs[id_col].cast("long").alias("id"), *[docs[c].alias(f"_keep_{c}") for c in keep])
    fields = [f for f in rows.schema.fields if f.name != "text"]
    added = ["weight", "held"] if held else ["weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            folds = _fold_of(batch.column(1), held[0]) if held else np.full(batch.num_rows, -1)
            sums, apart = [], []
            for fold, text in zip(folds, texts_as_bytes(batch.column(0))):
                found = ngram_buckets(text, len(ratio))
                sums.append(float(ratio[found].sum()))
                apart.append(float(held[1][fold][found].sum()) if fold >= 0 else None)
            columns = [pa.array(c, pa.float64()) for c in (sums, apart)][: len(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*batch.schema.names[1:], *added])

    return rows.mapInArrow(weigh, T.StructType([*fields, *(T.StructField(c, T.DoubleType()) for c in added)]))


def gumbel(seed: int, *parts: str) -> F.Column:
    """Seeded standard Gumbel noise of a row, the same in every run."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value of a column (the smallest if there are fewer), None for an empty one.

    Narrows a range of values by counts over 2^10 parts of it, a few times: no
    sort, and never more than these counts on the driver.
    """
    low, high, n = values.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n:
        return None
    k = min(k, n)
    for _ in range(_ROUNDS):
        width = (high - low) / (1 << _DIGITS)
        if width <= 0 or low + width == low:
            break
        part = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit((1 << _DIGITS) - 1))
        inside = values.filter((F.col(col) >= low) & (F.col(col) <= high)).groupBy(part.alias("part"))
        rows = sorted(inside.agg(F.count(col).alias("n"), F.min(col).alias("a"), F.max(col).alias("b")).collect(), reverse=True)
        for _, n, a, b in rows:
            if n >= k:
                low, high = a, b
                break
            k -= n
        if low == high:
            break
    if low < high:
        rows = values.filter((F.col(col) >= low) & (F.col(col) <= high)).groupBy(F.col(col).alias("v")).count().collect()
        for low, n in sorted(rows, reverse=True):
            k -= n
            if k <= 0:
                break
    return low


def resample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    seed: int = 11, keep: tuple[str, ...] = (),
) -> DataFrame:
    """`id`, `weight`, `noisy`, `selected` and the columns named in `keep` for every document.

    `weight` is the log ratio of a text under two hashed n-gram models: one of
    the texts labelled 1, one of all texts. Documents are drawn without
    replacement with probabilities in proportion to the ratios: Gumbel noise is
    added, and the k largest are selected. k is the number of documents in
    the whole corpus that weigh at least as much as `KEEP_TARGET` of the
    labelled target texts do, noise included. For this a labelled text is
    weighed by a target model made without its part of the labels, as texts
    without a label are, which the model has not seen either.

    Null texts count as empty and weigh 0; null ids are unlabelled, repeated
    rows share weight and noise, ties at the border are all selected. With no
    document labelled 1 every document is selected. The target model comes from
    at most `MAX_TARGETS` labelled ids, all counts cover all texts. Labels with a null id or a
    null value are left out; an id is a target if any of its labels is 1.
    """
    targets = labels.filter(labels[label_col] == 1).select(labels[id_col].cast("long").alias("id")).filter("id IS NOT NULL").distinct()
    targets = targets.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(MAX_TARGETS)
    ids = np.array([r["id"] for r in targets.collect()], np.int64)
    counts = _ngram_counts(docs, ids, id_col, text_col, BUCKETS)
    raw, target = counts[0], counts[1:].sum(axis=0)
    apart = np.stack([_ratio(raw, target - part) for part in counts[1:]])
    weighed = log_weights(docs, _ratio(raw, target), id_col, text_col, keep, (ids, apart))
    noise = gumbel(seed, "id", "weight")
    weighed = materialize(weighed.withColumns({"noisy": F.col("weight") + noise, "held": F.col("held") + noise}), "quality-weights")
    known = materialize(weighed.filter("held IS NOT NULL").select("held"), "quality-known")
    n_known = known.count()
    if not n_known:
        return _named(weighed.withColumn("selected", F.lit(True)), keep)
    floor = kth_largest(known, "held", max(1, int(np.ceil(KEEP_TARGET * n_known))))
    k = max(1, weighed.filter(F.col("noisy") >= floor).count())
    border = kth_largest(weighed, "noisy", k)
    return _named(weighed.withColumn("selected", F.col("noisy") >= F.lit(border)), keep)


def _named(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return rows.select("id", "weight", "noisy", "selected", *[F.col(f"_keep_{c}").alias(c) for c in keep])
