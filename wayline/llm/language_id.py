"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayline.llm.common import SLICE_BYTES, small_batches, word_slices
from wayline.operators.ordering import top_n_per_group
from wayline.session import materialize

#: Labelled texts of each language that its centroids are clustered from: a seeded sample, at most so many.
MAX_PER_LANGUAGE = 1_000
CENTROIDS = 3
ROUNDS = 10
#: Runs of 2 and 3 bytes are hashed to so many dimensions.
DIMENSIONS = 1 << 14
_RUNS = (2, 3)
#: A text is rejected if its cosine is below this share of what nearly all texts of its centroid reach.
REJECT_BELOW = 0.5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters in lower case, other ASCII as a space, all bytes of other characters as they are.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def has_letter(text: bytes, words: bytes) -> bool:
    """Whether a text has a letter of any script; `words` is the text without its ASCII signs."""
    return any(97 <= c <= 122 for c in words[:64]) or bool(words.strip(b" ")) and _LETTER.search(text.decode("utf-8", "replace")) is not None


def counts(text: bytes | None) -> np.ndarray | None:
    """How often each hashed run of bytes occurs in a whole text, signs and digits read as one space; None without a letter."""
    words = (text or b"").translate(_TABLE)
    if not has_letter(text or b"", words):
        return None
    total, tail = None, b" "
    for part in word_slices(words):
        part = b" ".join(part.split()) + b" "
        for start in range(0, len(part), SLICE_BYTES) if len(part) > 1 else ():
            joined = tail + part[start : start + SLICE_BYTES]
            piece = np.frombuffer(joined, np.uint8).astype(np.uint32)
            run, hashed = piece, []
            for n in _RUNS:
                run = (run[:-1] << np.uint32(8)) | piece[n - 1 :]
                fresh = run[max(0, len(tail) - n + 1) :]  # runs that end in the new part
                hashed.append(((fresh + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(18))
            found = np.bincount(np.concatenate(hashed), minlength=DIMENSIONS)
            total = found if total is None else total + found
            tail = joined[-(_RUNS[-1] - 1) :]
    return total


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions of a text and their weights, normalised."""
    at = np.flatnonzero(found)
    weights = np.log1p(found[at]) * idf[at]
    return at, weights / np.sqrt(weights @ weights)


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray | None]]]:
    for batch in small_batches(batches, 64):
        yield batch, [counts(v) for v in batch.column(column).cast(pa.binary()).to_pylist()]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of dimension and number of texts; dimension -1 counts all texts with a letter."""
    total = np.zeros(DIMENSIONS, np.int64)
    n = 0
    for _, found in _texts(batches):
        for one in found:
            if one is not None:
                total += one > 0
                n += 1
    met = np.flatnonzero(total)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1), pa.int32()), pa.array(np.append(total[met], n), pa.int64())], names=["dimension", "n"])


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit vectors, and for each the cosine that all but one in a hundred of its vectors reach.

    Begins with vectors that are spread evenly in order of their cosine with the mean.
    """
    order = np.argsort(vectors @ vectors.mean(axis=0), kind="stable")
    k = min(k, len(vectors))
    centroids = vectors[order[[(2 * i + 1) * len(order) // (2 * k) for i in range(k)]]]
    for _ in range(rounds):
        at = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[at == i].sum(axis=0) if (at == i).any() else c for i, c in enumerate(centroids)])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    cosines = vectors @ centroids.T
    at = np.argmax(cosines, axis=1)
    reached = [np.quantile(cosines[at == i, i], 0.01) if (at == i).any() else 1.0 for i in range(len(centroids))]
    return centroids, np.array(reached)


@dataclass(frozen=True)
class Model:
    """Centroids in order of their languages, which repeat."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    reached: np.ndarray
    idf: np.ndarray


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 12) -> Model:
    """The model of the rows for which `learn` is true and the language is known.

    Document frequencies come from all these rows, centroids from a seeded
    sample of at most MAX_PER_LANGUAGE of each language. Languages are few:
    one row for each, its size and centroids, goes through the driver.
    """
    known = docs.filter(learn & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    draw = F.pmod(F.xxhash64(F.lit(seed), docs[id_col]), F.lit(1 << 40))
    known = known.select(known[lang_col].cast("string").alias("lang"), known[text_col].alias("text"), draw.alias("draw"))
    totals = known.select("text").mapInArrow(_document_frequencies, "dimension int, n long").groupBy("dimension").agg(F.sum("n").alias("n"))
    n, df = 0, np.zeros(DIMENSIONS)
    for r in totals.collect():  # at most DIMENSIONS + 1 rows
        if r.dimension < 0:
            n = r.n
        else:
            df[r.dimension] = r.n
    idf = np.log((1 + n) / (1 + df)) + 1

    # The largest draw that is still taken of each language, then the rows up to it: equal draws are cut by the second ranking.
    first = [F.col("draw"), F.col("lang")]
    borders = top_n_per_group(known.select("lang", "draw"), ["lang"], first, MAX_PER_LANGUAGE).groupBy("lang").agg(F.max("draw").alias("draw"))
    border = F.lit(-1)
    for r in borders.collect():
        border = F.when(F.col("lang") == r.lang, F.lit(r.draw)).otherwise(border)
    drawn = top_n_per_group(known.filter(F.col("draw") <= border), ["lang"], [F.col("draw"), F.xxhash64("text")], MAX_PER_LANGUAGE)
    drawn = materialize(drawn, "language-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _texts(batches):
            rows = [(lang, draw, *vector(one, idf)) for lang, draw, one in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), found) if one is not None]
            if rows:
                langs, draws, at, weights = zip(*rows)
                columns = [pa.array(langs), pa.array(draws), pa.array(at, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "draw", "at", "weights"])

    def centroids(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("draw", kind="stable")
        dense = np.zeros((len(rows), DIMENSIONS), np.float32)
        for i, (at, weights) in enumerate(zip(rows["at"], rows["weights"])):
            dense[i, at] = weights
        found, reached = cluster(dense)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "place": range(len(found)), "centroid": list(found), "reached": reached})

    rows = drawn.select("text", "lang", "draw").mapInArrow(vectors, "lang string, draw long, at array<int>, weights array<double>")
    rows = rows.groupBy("lang").applyInPandas(centroids, "lang string, place int, centroid array<float>, reached double").collect()
    rows.sort(key=lambda r: (r.lang, r.place))
    matrix = np.array([r.centroid for r in rows], np.float64).reshape(len(rows), DIMENSIONS)
    return Model(tuple(r.lang for r in rows), matrix, np.array([r.reached for r in rows]), idf)


def predict_text(model: Model, found: np.ndarray | None) -> tuple[str, float, bool]:
    """Language, cosine and whether the text is rejected; of equally near centroids the first counts."""
    if found is None or not model.languages:
        return UNKNOWN, 0.0, True
    at, weights = vector(found, model.idf)
    cosines = model.centroids[:, at] @ weights
    best = int(np.argmax(cosines))
    score = float(min(1.0, max(0.0, cosines[best])))
    return model.languages[best], score, bool(score < REJECT_BELOW * model.reached[best])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `lang_pred`, `score` and `rejected` of every row, from its text alone.

    The score is the cosine with the nearest centroid. `lang_pred` is that
    centroid's language even where the text is too far from it and so
    `rejected`; null texts, texts without a letter, and all texts if there is
    nothing to learn from, are `und`, score 0 and rejected.

    Texts of any length are read whole, in parts; null ids are allowed;
    repeated rows get equal answers; other columns are ignored; an empty table
    gives an empty result.
    """

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _texts(batches, 1):
            if batch.num_rows:
                langs, scores, rejected = zip(*(predict_text(model, one) for one in found))
                columns = [batch.column(0), pa.array(langs), pa.array(scores, pa.float64()), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "rejected"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(answer, f"id {id_type}, lang_pred string, score double, rejected boolean")
