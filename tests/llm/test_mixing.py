from collections import defaultdict

import pytest

from wayline.llm import source_mixing
from .conftest import pairs


def fill_by_hand(sizes, weights, share, epochs):
    """Targets by repeated resharing of what is above the caps."""
    caps = {s: n * epochs for s, n in sizes.items()}
    total, target, open_ = sum(sizes.values()) * share, {}, dict(weights)
    left = total
    while open_:
        full = {s for s in open_ if left * open_[s] / sum(open_.values()) >= caps[s]}
        if not full:
            target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        left -= sum(caps[s] for s in full)
        target |= {s: caps[s] for s in full}
        open_ = {s: w for s, w in open_.items() if s not in full}
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 0, 40], [7], [3, 3, 3, 3, 3, 300], [100, 1, 100, 1, 100, 1]])
def test_water_filling_equals_resharing(spark, sizes):
    rows = [(f"s{i}", n, float([3, 1, 2][i % 3]), i) for i, n in enumerate(sizes)]
    found = source_mixing.water_filling(spark.createDataFrame(rows, "source string, source_size long, weight double, _place int"))
    expected = fill_by_hand({r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}, 1.5, 2.0)
    assert {r.source: r.target for r in found.collect()} == pytest.approx(expected)


def test_mix_takes_whole_and_fractional_repetitions(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), ["b", "a", None, "é", "z"][i % 5 if i % 3 else 0]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = source_mixing.mix(docs).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, source_mixing.mix(docs.repartition(7)).collect()))
    taken, size, target = defaultdict(int), defaultdict(int), {}
    for r in first:
        assert r.repeats <= 2 and r.source_size >= r["size"]
        taken[r.source] += r["size"] * r.repeats
        size[r.source] += r["size"]
        target[r.source] = r.target
    names = sorted((s for s in size if s), key=lambda s: s.encode()) + [None]
    expected = fill_by_hand(size, {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(names)}, 1.5, 2.0)
    assert target == pytest.approx(expected)
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)


def test_mix_on_odd_and_empty_tables(odd_docs, empty_docs):
    mixed = source_mixing.mix(odd_docs, keep=("size", "draw", "text"))
    assert mixed.count() == odd_docs.count()
    assert len({r.repeats for r in mixed.filter("id = 4").collect()}) == 1  # repeated rows share their draw
    assert source_mixing.mix(empty_docs).collect() == []


def test_sources_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", "a"), (3, "x", "b")], "doc_id long, text string, source string")
    assert pairs(source_mixing.mix(docs), "id", "target", "repeats") == [(1, 0.0, 0), (2, 0.0, 0), (3, 1.5, 2)]
