import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayline.llm import quality_resampling, toxicity_chain

CATEGORIES = {"unfit": "1 - quality", "toxic": "toxic"}


def corpus(spark, n=600, seed=4):
    """Texts of which some hold words of two lists; every second one is labelled."""
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(pick.paretovariate(0.7)) % 2000}" for _ in range(pick.randint(5, 60))]
        toxic, bad = i % 7 == 0, i % 5 == 0
        if toxic:
            words[pick.randrange(len(words))] = pick.choice(["hateful", "vileA", "vileB", "vileC"])
        if bad:
            words = [f"{w}!!" if pick.random() < 0.5 else "###" for w in words] + ["###"] * 3
        rows.append((i, " ".join(words), "s", 1))
        labels.append((i, int(not bad), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, fold int")
    return docs, spark.createDataFrame(labels[::2], "doc_id long, quality int, toxic int"), labels


def test_chain_on_held_out_texts(spark):
    docs, known, labels = corpus(spark)
    rows = {r.id: r for r in toxicity_chain.toxicity(docs, known, CATEGORIES).collect()}
    held = [x for x in labels if x[0] % 2]
    assert sum(rows[i].is_toxic == bool(t) for i, _, t in held) / len(held) > 0.97
    assert sum(rows[i].is_unfit == (not q) for i, q, _ in held) / len(held) > 0.97
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_unfit <= 1 for r in rows.values())


def test_chain_feeds_earlier_probabilities(spark):
    docs, known, _ = corpus(spark, 200)
    sample = toxicity_chain.training_sample(known, "doc_id", CATEGORIES, 5)
    chain = toxicity_chain.fit_chain(docs, sample, list(CATEGORIES), "doc_id", "text")
    assert [len(m.earlier) for m in chain.models] == [0, 1]


def test_training_sample_is_bounded_and_merges_labels(spark):
    rows = [(i, 1, 0) for i in range(50)] + [(i, 0, 1) for i in range(60, 63)] + [(60, 1, 0), (None, 1, 1), (70, None, 1)]
    sample = toxicity_chain.training_sample(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), "doc_id", CATEGORIES, 5, cap=10).collect()
    assert Counter((r.unfit, r.toxic) for r in sample) == {(0, 0): 10, (1, 1): 3}
    assert {((r.unfit, r.toxic), r.weight) for r in sample} == {((0, 0), 5.0), ((1, 1), 1.0)}


def test_labels_that_no_word_explains(spark):
    """A model that knows nothing but a share predicts none, whatever the text."""
    pick = random.Random(9)
    texts = [" ".join(f"w{pick.randrange(60)}" for _ in range(20)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), int(pick.random() < 0.15)) for i in range(200)], "doc_id long, quality int, toxic int")
    rows = toxicity_chain.toxicity(docs, labels, CATEGORIES).collect()
    assert sum(r.is_toxic for r in rows) <= 0.15 * len(rows) and sum(r.is_unfit for r in rows) <= 0.2 * len(rows)
    assert np.mean([r.p_unfit for r in rows]) == pytest.approx(0.2, abs=0.1)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not present")
def test_labelled_texts_of_the_tables(spark):
    """Held-out half of the labels: toxic texts found, good ones left alone."""
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    docs, labels = read("documents"), read("labels")
    scored = toxicity_chain.toxicity(docs, labels, CATEGORIES).withColumnRenamed("id", "doc_id").join(labels, "doc_id").collect()
    toxic, fine = [r for r in scored if r.toxic], [r for r in scored if not r.toxic and r.quality]
    assert sum(r.is_toxic for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.is_unfit for r in fine) <= 0.05 * len(fine) and sum(r.is_toxic for r in fine) <= 0.02 * len(fine)


def test_chain_equals_plain_numpy(spark):
    """Terms, folds, out-of-fold log odds, weights and probabilities, computed again row by row."""
    docs, known, _ = corpus(spark, 240)
    sample = toxicity_chain.training_sample(known, "doc_id", CATEGORIES, 5)
    chain = toxicity_chain.fit_chain(docs, sample, list(CATEGORIES), "doc_id", "text")
    rows = {r.id: r for r in sample.collect()}
    words = {r.doc_id: set(r.t) for r in docs.select("doc_id", toxicity_chain.terms(F.col("text")).alias("t")).collect()}
    ids = sorted(rows)
    tests = sum(n >= 3 for n in Counter(t for i in ids for t in words[i]).values())

    def log_p(name, t, among):
        share = sum(rows[i][name] for i in among) / len(among)
        having = [rows[i][name] for i in among if t in words[i]]
        r = sum(having) / len(having) if having else 0
        return -len(having) * (r * math.log(r / share) + ((1 - r) * math.log((1 - r) / (1 - share)) if r < 1 else 0)) if r > share else 0

    def chosen(name, among, rate):
        p = {t: log_p(name, t, among) for t in {t for i in ids for t in words[i]} if sum(t in words[i] for i in ids) >= 3}
        ranked = sorted(p, key=p.get)
        last = max([k for k, t in enumerate(ranked, 1) if p[t] < 0 and p[t] <= math.log(rate * k / tests)], default=0)
        return set(ranked[:last])

    def optimum(x, y, penalty):
        beta = np.zeros(x.shape[1] + 1)
        x = np.column_stack([x, np.ones(len(x))])
        ridge = np.append(np.full(len(beta) - 1, penalty), 0)
        for _ in range(400):  # shortened Newton steps
            q = 1 / (1 + np.exp(-x @ beta))
            beta = beta - 0.3 * np.linalg.solve((x.T * (q * (1 - q))) @ x + np.diag(ridge + 1e-9), x.T @ (q - y) + ridge * beta)
        return beta

    train = {i: [] for i in ids}  # log odds that later models learn from
    seen = {i: [] for i in words}  # and those they predict from
    found = {r.id: r for r in toxicity_chain.toxicity(docs, known, CATEGORIES).collect()}
    for name, model in zip(CATEGORIES, chain.models):
        def fitted(among, terms, penalty):
            x = np.array([[t in words[i] for t in terms] + train[i] for i in among], float).reshape(len(among), -1)
            return optimum(x, np.array([rows[i][name] for i in among], float), penalty)

        def loss(penalty, rate):
            p = {}
            for fold in range(toxicity_chain.FOLDS):
                rest = [i for i in ids if rows[i].fold != fold]
                terms = sorted(chosen(name, rest, rate))
                beta = fitted(rest, terms, penalty)
                p |= {i: 1 / (1 + math.exp(-(np.array([t in words[i] for t in terms] + train[i] + [1.0], float) @ beta))) for i in ids if rows[i].fold == fold}
            return -sum(math.log(max(q, 1e-6) if rows[i][name] else max(1 - q, 1e-6)) for i, q in p.items()), penalty, rate, p

        first = min((loss(c, 0.05) for c in toxicity_chain.PENALTIES), key=lambda f: f[:3])
        _, penalty, rate, held = min([first, loss(first[1], 0.5)], key=lambda f: f[:3])
        terms = list(model.terms)
        if len(chosen(name, ids, rate)) < toxicity_chain.MAX_TERMS and set(terms) <= chosen(name, ids, 0.5):
            assert set(terms) == chosen(name, ids, rate)
        beta = fitted(ids, terms, penalty)
        assert beta == pytest.approx([*model.weights, *model.earlier, model.intercept], abs=0.05)
        for i in words:
            z = sum(w for t, w in zip(terms, model.weights) if t in words[i]) + model.intercept + sum(w * v for w, v in zip(model.earlier, seen[i]))
            assert found[i][f"p_{name}"] == pytest.approx(1 / (1 + math.exp(-z)))
            assert found[i][f"is_{name}"] == (found[i][f"p_{name}"] >= model.threshold)
            p = min(max(found[i][f"p_{name}"], 1e-6), 1 - 1e-6)
            seen[i].append(math.log(p / (1 - p)))
        for i in ids:
            p = min(max(held[i], 1e-6), 1 - 1e-6)
            train[i] = train[i] + [math.log(p / (1 - p))]


def test_chain_on_odd_and_empty_tables(spark, odd_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity_chain.toxicity(odd_docs, none, CATEGORIES, keep=("row", "text")).collect()
    assert len(rows) == odd_docs.count() and {(r.p_toxic, r.is_toxic) for r in rows} == {(0.0, False)}
    one = spark.createDataFrame([(1, 1, 1), (4, 1, 1), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert {(r.p_unfit, r.p_toxic) for r in toxicity_chain.toxicity(odd_docs, one, CATEGORIES).collect()} == {(0.0, 1.0)}
    some = spark.createDataFrame([(1, 1, 1), (4, 1, 0), (5, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    scored = toxicity_chain.toxicity(odd_docs, some, CATEGORIES).collect()
    assert len(scored) == odd_docs.count() and len({r.p_toxic for r in scored if r.id == 4}) == 1
    assert toxicity_chain.toxicity(empty_docs, some, CATEGORIES).collect() == []


def test_weights_equal_plain_models(spark):
    docs, labels, _ = corpus(spark, 120)
    buckets = 500
    ids = np.array([r.doc_id for r in labels.filter("quality = 1").collect()])
    ratio = quality_resampling.log_ratio(docs, ids, "doc_id", "text", buckets)
    raw, target = np.ones(buckets), np.ones(buckets)
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    for i, t in texts.items():
        for b in quality_resampling.ngram_buckets(t, buckets):
            raw[b] += 1
            target[b] += i in ids
    expected = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert ratio == pytest.approx(expected)
    found = {r.id: r.weight for r in quality_resampling.log_weights(docs, ratio, "doc_id", "text").collect()}
    for i, t in texts.items():
        assert found[i] == pytest.approx(sum(expected[b] for b in quality_resampling.ngram_buckets(t, buckets)))


def test_ngrams_do_not_depend_on_slices(monkeypatch):
    text = (" ".join(f"Word{i}" for i in range(500)) + "\n").encode()
    whole = sorted(quality_resampling.ngram_buckets(text))
    cut = quality_resampling.word_slices
    monkeypatch.setattr(quality_resampling, "word_slices", lambda t: cut(t, 50))
    assert sorted(quality_resampling.ngram_buckets(text)) == whole and len(whole) == 999


def test_selection_is_the_gumbel_top_k(spark):
    docs, labels, known = corpus(spark)
    rows = quality_resampling.resample(docs, labels, keep=("id",)).collect()
    k = sum(r.selected for r in rows)
    assert {r["noisy"] for r in rows if r.selected} == set(sorted((r["noisy"] for r in rows), reverse=True)[:k])
    good = {i for i, q, _ in known if q}
    chosen = [i for i, r in enumerate(rows) if r.selected]
    ids = {r[0] for r in rows if r.selected}
    assert len(ids & good) >= 0.98 * len(good) and len(ids - good) <= 0.1 * len(chosen)


def test_gumbel_noise_has_its_mean_and_spread(spark):
    row = spark.range(20000).select(quality_resampling.gumbel(1, "id").alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert row[0] == pytest.approx(0.5772, abs=0.03) and row[1] == pytest.approx(math.pi / 6**0.5, abs=0.03)


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 1.0], [3.0, -2.0, 1e9, 3.0, 1e-12, 0.0] * 3, [math.sin(i) ** 9 for i in range(500)]])
def test_kth_largest(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in {1, 2, len(values) // 2 + 1, len(values), len(values) + 5}:
        assert quality_resampling.kth_largest(frame, "v", k) == sorted(values, reverse=True)[min(k, len(values)) - 1]
    assert quality_resampling.kth_largest(frame.limit(0), "v", 3) is None


def test_selection_on_odd_and_empty_tables(spark, odd_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_resampling.resample(odd_docs, none, keep=("n", "weight")).collect()
    assert len(rows) == odd_docs.count() and all(r.selected for r in rows)
    some = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (5, 0), (6, None)], "doc_id long, quality int")
    rows = quality_resampling.resample(odd_docs, some).collect()
    assert len(rows) == odd_docs.count()
    assert {r.weight for r in rows if r.id in (2, 3, 7)} == {0.0} and len({r["noisy"] for r in rows if r.id == 4}) == 1
    assert quality_resampling.resample(empty_docs, some).collect() == []


def test_clean_texts_without_a_label_are_kept_at_every_length(spark):
    pick = random.Random(9)
    text = lambda n: " ".join(f"w{int(pick.paretovariate(0.4)) % 50_000}" for _ in range(n))
    lengths = [(10, 100)] * 6 + [(300, 1000)] * 3 + [(1000, 3000)]
    rows = [(i, text(pick.randint(*lengths[i % 10]))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, 1) for i in range(600) if i // 10 % 2], "doc_id long, quality int")
    kept = {r.id for r in quality_resampling.resample(docs, labels).filter("selected").collect()}
    for low, high in set(lengths):
        held = [i for i in range(600) if lengths[i % 10] == (low, high) and not i // 10 % 2]
        assert sum(i in kept for i in held) >= 0.95 * len(held), (low, high)
