import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayline.llm import language_id
from wayline.llm.common import small_batches, word_slices

SYLLABLES = {"xa": "ka ro mi tu lo sen", "yb": "ské ždo čro pří lům vět", "zc": "шта мор кле дин бов рас"}


def corpus(spark, n=240, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        words = ["".join(draw.choices(SYLLABLES[lang].split(), k=draw.randint(1, 4))) for _ in range(draw.randint(3, 60))]
        rows.append((i, " ".join(words) + " 1234 ### !", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def counts_by_hand(text):
    """Runs counted one by one over the whole text."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c if c.isalpha() or ord(c) > 127 else " " for c in text)
    data = b" " + " ".join(w for w in words.split(" ") if w).encode() + b" "
    total = np.zeros(language_id.DIMENSIONS, np.int64)
    for n in language_id._RUNS:
        for i in range(len(data) - n + 1):
            run = int.from_bytes(data[i : i + n], "big")
            total[((run + n) * 2654435761 & 0xFFFFFFFF) >> 18] += 1
    return total


@pytest.mark.parametrize("size", [1 << 20, 50, 7, 3])
def test_runs_are_counted_whatever_the_parts(monkeypatch, size):
    monkeypatch.setattr(language_id, "SLICE_BYTES", size)
    monkeypatch.setattr(language_id, "word_slices", lambda text: word_slices(text, size))
    for text in ("The quick  brown-fox", "Été à Zürich 中文 Ωmega", "x", "a1b2 c3" * 40, "w" * 500):
        assert (language_id.counts(text.encode()) == counts_by_hand(text)).all()


def test_texts_without_a_letter():
    for text in (None, b"", b"123 ### 4", " 。、１２".encode(), "🙂🙂".encode(), b"_"):
        assert language_id.counts(text) is None
    assert language_id.counts("1 é".encode()) is not None
    assert language_id.counts(("1" * 200 + " 中").encode()) is not None


def test_model_equals_plain_numpy(spark):
    docs, rows = corpus(spark)
    model = language_id.fit(docs, F.col("doc_id") % 2 == 0)
    known = [(lang, language_id.counts(text.encode())) for i, text, lang in rows if i % 2 == 0]
    df = sum((c > 0).astype(float) for _, c in known)
    idf = np.log((1 + len(known)) / (1 + df)) + 1
    assert model.idf == pytest.approx(idf)
    assert model.languages == tuple(lang for lang in sorted(SYLLABLES) for _ in range(3))
    assert np.linalg.norm(model.centroids, axis=1) == pytest.approx(np.ones(9), abs=1e-5)
    # Every centroid is the direction of the texts that are nearest to it.
    for lang in SYLLABLES:
        rows_of = [np.log1p(c) * idf for name, c in known if name == lang]
        unit = np.stack([v / np.linalg.norm(v) for v in rows_of])
        mine = model.centroids[[x == lang for x in model.languages]]
        at = np.argmax(unit @ mine.T, axis=1)
        for k in range(3):
            mean = unit[at == k].sum(axis=0)
            assert mine[k] @ mean / np.linalg.norm(mean) > 0.999
    for r in language_id.predict(docs, model).collect():
        text = rows[r.id][1]
        v = np.log1p(language_id.counts(text.encode())) * idf
        cosines = model.centroids @ (v / np.linalg.norm(v))
        assert (r.lang_pred, r.score) == (model.languages[int(np.argmax(cosines))], pytest.approx(min(1.0, cosines.max())))


def test_held_out_accuracy_and_rejection(spark):
    docs, rows = corpus(spark, 600)
    model = language_id.fit(docs, F.col("doc_id") % 4 != 2)
    found = language_id.predict(docs, model).collect()
    held = [r for r in found if r.id % 4 == 2]
    assert sum(r.lang_pred == rows[r.id][2] for r in held) / len(held) > 0.99
    assert sum(r.rejected for r in held) / len(held) < 0.02
    odd = spark.createDataFrame([(1, "qqqq zzzz wwww xxxx jjjj " * 20)], "doc_id long, text string")
    assert [r.rejected for r in language_id.predict(odd, model).collect()] == [True]


def test_learns_only_from_the_rows_named(spark):
    docs, _ = corpus(spark)
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, F.lit("xx")).otherwise(F.col("lang")))
    a, b = language_id.fit(docs, F.col("doc_id") % 2 == 0), language_id.fit(wrong, F.col("doc_id") % 2 == 0)
    assert a.languages == b.languages and (a.centroids == b.centroids).all()


def test_samples_are_bounded(spark, monkeypatch):
    """Copies share their draw; the sample is bounded all the same."""
    monkeypatch.setattr(language_id, "MAX_PER_LANGUAGE", 20)
    rows = [(1, "the same text", "a")] * 300 + [(i, f"other text {i}", "b") for i in range(300)] + [(i, f"few {i}", "c") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    assert set(model.languages) == {"a", "b", "c"}


def test_odd_and_empty_tables(spark, odd_docs, empty_docs):
    model = language_id.fit(odd_docs, F.lit(True), lang_col="source")
    found = language_id.predict(odd_docs, model)
    assert found.count() == odd_docs.count()
    by_id = {}
    for r in found.collect():
        assert by_id.setdefault(r.id, r) == r  # repeated rows get equal answers
        assert 0.0 <= r.score <= 1.0
    assert by_id[2].lang_pred == by_id[3].lang_pred == by_id[7].lang_pred == "und" and by_id[5].lang_pred in ("a", "b", "c")
    assert language_id.predict(empty_docs, model).collect() == []
    nothing = language_id.fit(empty_docs, F.lit(True), lang_col="source")
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd_docs, nothing).collect()} == {("und", 0.0)}


def test_batches_are_bounded_by_bytes():
    texts = ["x" * (50 << 20), None, "y", "z" * (3 << 20), "z" * (3 << 20), *["small"] * 1_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    parts = list(small_batches(iter([batch])))
    assert [v for p in parts for v in p.column(0).to_pylist()] == list(range(len(texts)))
    assert max(p.num_rows for p in parts) == 256
    for p in parts:
        assert p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 4 << 20
    assert list(small_batches(iter([batch.slice(0, 0)]))) == []
