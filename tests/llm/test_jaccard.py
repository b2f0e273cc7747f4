import random
import re

import pytest

from wayline.llm import jaccard_join
from wayline.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components_by_hand(docs):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[top(a)] = top(b)
    named = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            named[top(k)] = min(i, named.get(top(k), i))
    return sorted(((i, len(sets[k]), named.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(docs)), key=repr)


def made_docs(seed):
    """Chains of ever more changed copies, passages that many texts share, and texts of a few words."""
    pick = random.Random(seed)
    shared = [" ".join(f"p{pick.randint(0, 99)}" for _ in range(60)) for _ in range(2)]
    texts = []
    for _ in range(25):
        words = [f"w{pick.randint(0, 400)}" for _ in range(pick.randint(5, 80))]
        for _ in range(pick.randint(1, 8)):
            texts.append(" ".join(words))
            for _ in range(pick.randint(0, 3)):
                words[pick.randrange(len(words))] = f"w{pick.randint(0, 400)}"
            if pick.random() < 0.3:
                words += [f"w{pick.randint(0, 400)}"]
    texts += [f"{pick.choice(shared)} " + " ".join(f"t{pick.randint(0, 999)}" for _ in range(pick.choice([1, 3, 10, 40]))) for _ in range(60)]
    texts += ["one", "ONE", "one two", "one two three four", "one two three four five", "", None, " \n"]
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, frequent", [(1, 1 << 19), (2, 4), (3, 0)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(jaccard_join, "MAX_FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "MIN_FREQUENT", 3)
    docs = made_docs(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = jaccard_join.jaccard_components(frame)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == components_by_hand(docs)


def test_components_on_odd_and_empty_tables(odd_docs, empty_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    found = jaccard_join.jaccard_components(odd_docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == components_by_hand(docs)
    assert jaccard_join.jaccard_components(empty_docs).collect() == []


def test_ids_that_are_null_only(spark):
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b d")], "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard_join.jaccard_components(frame).collect()), key=repr) == [(3, 1, 3), (None, 1, None), (None, 1, None)]


def test_connected_components(spark):
    links = [(k, k + 1) for k in range(10, 30)] + [(5, 7), (7, 30), (1, 2), (3, 2), (9, 8)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert {n for n, r in roots.items() if r == 5} == {5, 7, *range(10, 31)}
    assert (roots[1], roots[2], roots[3], roots[8], roots[9]) == (1, 1, 1, 8, 8)
    more = connected_components(spark.createDataFrame([(1, 9), (40, 41)], "a long, b long"), found)
    roots = {r.node: r.root for r in more.collect()}
    assert roots[3] == roots[8] == roots[9] and roots[40] == roots[41] and roots[5] == roots[30]


def test_longer_copies_that_meet_smaller_sets_only(spark):
    """Copies with appended text: the longer set's own shingles come first, so its lists lie below its own block."""
    pick = random.Random(5)
    word = iter(range(10**6))
    new = lambda n: [f"n{next(word)}" for _ in range(n)]
    texts = []
    for _ in range(40):  # each appended part is in a second text too, so that its shingles are repeated ones
        size, added = pick.randint(60, 160), pick.uniform(0, 0.33)
        base, tail = new(size), new(int(size * added))
        texts += [" ".join(base), " ".join(base + tail), " ".join(new(300) + tail)]
        texts += [" ".join(base[:k] + new(1) + base[k + 1 :]) for k in (3, size // 2)]
    pick.shuffle(texts)
    docs = list(enumerate(texts))
    found = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == components_by_hand(docs)


def test_link_of_two_groups_through_a_larger_set(spark):
    """u and u1 are linked, v and v0 are, and u with v: only one list has u and v where that can be seen, u1 and v0 are
    its pivots, and v's position lets it visit no block of its own size."""
    word = iter(range(10**6))
    new = lambda n: [f"n{next(word)}" for _ in range(n)]
    core, tail = new(84), new(21)  # 80 shingles; the 75 that all four have are frequent, the five of u and v more so
    u, u1, v, v0 = core + new(5), core[5:] + new(7), core + tail, core[5:] + tail[:18] + new(7)
    texts = [u, u1, v, v0, *(core + new(300) for _ in range(10)), *(core[:9] + new(300) for _ in range(10))]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    expected = components_by_hand(docs)
    assert [c for _, _, c in sorted(expected)[:5]] == [0, 0, 0, 0, 4]
    found = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


def test_compared_pairs_follow_the_size_of_a_group(spark, monkeypatch):
    """Near copies of one text, some too far from it: twice the copies, about twice the comparisons."""
    import random

    overlaps, compared = jaccard_join._overlaps, []

    def counting(pairs, sets):
        compared.append(pairs.count())
        return overlaps(pairs, sets)

    monkeypatch.setattr(jaccard_join, "_overlaps", counting)
    totals = []
    for n in (100, 200, 400):
        draw = random.Random(5)
        base = [f"w{i}" for i in range(150)]
        rows = []
        for i in range(n):
            words = list(base)
            for _ in range(draw.choice([1, 2, 3, 4, 5])):
                words[draw.randrange(len(words))] = draw.choice("abcdefgh")
            rows.append((i, " ".join(words)))
        compared.clear()
        found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        totals.append(sum(compared))
        if n == 200:
            assert {r.id: r.component for r in found} == plain_components(rows)
    assert totals[1] <= 3 * totals[0] + 200 and totals[2] <= 3 * totals[1] + 200


def plain_components(rows):
    sets = {}
    for i, text in rows:
        words = text.split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = sorted((top(a), top(b)))
                root[rb] = ra
    return {i: top(i) for i in ids}
