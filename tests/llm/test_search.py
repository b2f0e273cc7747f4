import math
import random
from collections import Counter

import numpy as np
import pytest

from wayline.llm import bm25_search, hash_forest
from .conftest import pairs


def bm25_by_hand(docs, queries, k):
    words = {i: Counter(bm25_words(t)) for i, t in docs}
    length = {i: sum(c.values()) for i, c in words.items()}
    average, n = sum(length.values()) / len(words), len(words)
    df = Counter(w for c in words.values() for w in c)
    out = []
    for q, text in queries:
        scores = {}
        for i, c in words.items():
            hit = [w for w in set(bm25_words(text)) if w in c]
            if hit:
                norm = 1.2 * (0.25 + 0.75 * length[i] / average)
                scores[i] = round(sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w in hit), 9)
        best = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(best)]
    return sorted(out)


def bm25_words(text):
    return (text or "").encode().translate(bm25_search._PLAIN).split()


@pytest.mark.parametrize("shard_words", [400, 8_000_000])
def test_bm25_equals_full_scoring(spark, monkeypatch, shard_words):
    monkeypatch.setattr(bm25_search, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(bm25_search, "LONG_LIST", 8)
    monkeypatch.setattr(bm25_search, "BLOCK", 4)
    pick = random.Random(2)
    docs = [(i, " ".join(f"W{int(pick.paretovariate(0.6)) % 300}" for _ in range(pick.randint(0, 40)))) for i in range(200)]
    docs += [(200 + i, docs[i][1]) for i in range(20)] + [(300, None), (301, ""), (302, "unique, é-é")]
    queries = [d for d in docs if d[0] % 20 == 0] + [(302, "unique, é-é")]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, terms string, shard int")
    found = bm25_search.search(frame, frame.filter("doc_id % 20 = 0 OR doc_id = 302"), 5)
    got = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in found.collect())
    expected = bm25_by_hand(docs, queries, 5)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expected], abs=1e-8)


def test_bm25_index_keeps_copies_once_and_floors_cut(monkeypatch):
    monkeypatch.setattr(bm25_search, "LONG_LIST", 8)
    pick = random.Random(3)
    texts = [" ".join(f"w{int(pick.paretovariate(0.5)) % 400}" for _ in range(pick.randint(1, 60))).encode() for _ in range(300)]
    index = bm25_search.Index(30.0, np.ones(bm25_search._FILTER_BITS, bool))
    for id_, text in enumerate([*texts, *texts[:1] * 2000]):
        index.add(id_, text)
    index.build()
    assert len(index.ids) == len({*texts}) and len(index.long) and len(index.texts) < 300 * 60
    terms = [np.unique(bm25_search.term_codes(t)) for t in texts]
    weights = [np.array([pick.uniform(0.1, 9) for _ in t]) for t in terms]
    free = index.top([(t, w, 0.0) for t, w in zip(terms, weights)], 10)
    assert free[0][0].tolist() == [0, *range(300, 309)] and len({*free[0][1]}) == 1
    floors = [s[len(s) // 2] for _, s in free]
    cut = index.top([(t, w, f) for t, w, f in zip(terms, weights, floors)], 10)
    for (ids, scores), (few, best), floor in zip(free, cut, floors):
        assert few.tolist() == ids[scores >= floor].tolist() and best.tolist() == scores[scores >= floor].tolist()


def test_bm25_ties_of_copies_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(bm25_search, "SHARD_WORDS", 300)
    pick = random.Random(4)
    docs = [(i, " ".join(f"w{pick.randint(0, 80)}" for _ in range(12))) for i in range(150)]
    docs += [(1000 - i, docs[i % 3][1]) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = bm25_search.search(frame, frame.filter("doc_id < 30"), 10)
    got = sorted((r.query_id, r["rank"], r.doc_id) for r in found.collect())
    assert got == [e[:3] for e in bm25_by_hand(docs, docs[:30], 10)]


def test_bm25_on_odd_and_empty_tables(odd_docs, empty_docs):
    found = bm25_search.search(odd_docs, odd_docs, 20)
    assert {(1, 1), (9, 9), (4, 9), (12, 5)} <= set(pairs(found, "query_id", "doc_id"))
    assert not {2, 3, 7, None} & {r.query_id for r in found.select("query_id").collect()}
    assert bm25_search.search(empty_docs, empty_docs).collect() == []
    assert bm25_search.search(odd_docs, empty_docs).collect() == []


def test_forest_finds_nearest_and_leaves_out_unusable(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)))]
    bad = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] + [1.0] * 7), (904, [float("inf")] * 8), (None, [1.0] * 8), (1000, [1.0, 2.0])]
    twice = [(700, vectors[5][1]), (701, vectors[5][1])]
    frame = spark.createDataFrame([(i, v, 3, "s") for i, v in vectors + bad + twice], "vec_id long, embedding array<float>, shard int, kind string")
    rows = hash_forest.nearest(frame, frame.filter("vec_id % 50 = 0 OR vec_id = 5"), shard_rows=200).collect()
    space = {i: np.array(v, np.float32).astype(float) for i, v in vectors + twice}
    hits = total = 0
    for q in {r.query_id for r in rows}:
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        if q == 1000:
            pytest.fail("a vector of another length was compared")
        far = sorted((float(np.sqrt(((space[i] - space[q]) ** 2).sum())), i) for i in space if i != q)
        assert [r.score for r in mine] == pytest.approx([math.dist(space[r.vec_id], space[q]) for r in mine])
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits, total = hits + len({r.vec_id for r in mine} & {i for _, i in far[:10]}), total + 10
    assert hits / total >= 0.9
    assert [r.vec_id for r in sorted((r for r in rows if r.query_id == 5), key=lambda r: r["rank"])][:2] == [700, 701]
    few = hash_forest.nearest(frame.filter("vec_id < 4"), frame.filter("vec_id = 0"))
    assert few.count() == 3
    assert hash_forest.nearest(frame.limit(0), frame.limit(0)).collect() == []


def test_forest_recall_on_the_driver_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = hash_forest.nearest(frame, frame.filter("vec_id % 100 = 0")).collect()
    space = {r.vec_id: np.array(r.embedding, float) for r in frame.collect()}
    hits = 0
    for q in {r.query_id for r in rows}:
        far = sorted((float(np.sqrt(((v - space[q]) ** 2).sum())), i) for i, v in space.items() if i != q)[:10]
        hits += len({i for _, i in far} & {r.vec_id for r in rows if r.query_id == q})
    assert hits / len(rows) >= 0.9
