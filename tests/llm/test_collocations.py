import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from wayline.llm import collocations
from .conftest import pairs

COLUMNS = "lang rank phrase a l r n score".split()


def by_hand(texts, min_count=10, percent=50, top=2_000):
    """All phrases counted directly."""
    found = defaultdict(Counter)
    for lang, text in texts:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    found[lang or "und"][tuple(words[i : i + k])] += 1
    rows = []
    for lang, f in found.items():
        longest = defaultdict(int)
        for p, a in f.items():
            if len(p) == 3 and a >= min_count:
                for part in (p[:2], p[1:]):
                    longest[part] = max(longest[part], a)
        ranked = []
        for p, a in f.items():
            if len(p) > 1 and a >= min_count and not (len(p) == 2 and longest[p] and 100 * longest[p] >= percent * a):
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(c for p, c in f.items() if len(p) == 1)
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(rows)


def example():
    """Frequent words and passages, pieces of every length, words in two languages, odd blanks and bytes."""
    texts = []
    for i in range(400):
        words = [f"W{(i * 31 + j * j) % 17}" for j in range(i % 23)]
        marks = " .\t,\n;:!?\r\x0b\x0c  "
        texts.append((["en", "de", None, "und"][i % 4], "".join(w + (marks[(i + j) % len(marks)] if j % 3 == 0 else " ") for j, w in enumerate(words))))
    texts += [("en", "the same passage again and again, as it was ")] * 30 + [("en", "the same. The same\tTHE same x\x00y ÄÖ äö é")] * 12
    texts += [("fr", " ".join(f"v{j * j % 41}" for j in range(5_000)))] + [("fr", None), (None, ""), ("en", " . , "), ("de", "x" * 5_000)]
    return texts


@pytest.mark.parametrize("min_count,percent,top", [(10, 50, 2_000), (1, 100, 7), (3, 80, None)])
def test_collocations_equal_counting_all(spark, min_count, percent, top):
    texts = example()
    docs = spark.createDataFrame([(l, t, 1, 2) for l, t in texts], "lang string, text string, n long, w1 long").repartition(5)
    found = collocations.collocations(docs, min_count=min_count, covered_percent=percent, top=top)
    expected = by_hand(texts, min_count, percent, top)
    assert sorted(tuple(r) for r in found.select(*COLUMNS).collect()) == expected and expected


@pytest.mark.parametrize("places,words,slices,rows", [(7, 40, 11, 1), (50, 9, 1 << 20, 3), (1 << 20, (1 << 20) - 1, 64, 1_000)])
def test_graph_in_small_parts(monkeypatch, places, words, slices, rows):
    """The same counts however texts, batches and the words remembered are cut."""
    for name, value in (("PLACES", places), ("SLICE_BYTES", slices)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations, "FLUSH_WORDS", words)
    texts = example()[::3] + example()[-5:]
    batch = pa.RecordBatch.from_arrays([pa.array([l or "und" for l, _ in texts]), pa.array([t for _, t in texts])], names=["lang", "text"])
    edges = pa.Table.from_batches(list(collocations._local_edges(iter([batch]))))
    ordered = edges.sort_by([(c, "ascending") for c in ("w1", "w2", "w3")]).combine_chunks()
    folded = list(collocations._fold(3)(iter(ordered.to_batches(max_chunksize=rows))))
    whole = list(collocations._fold(3)(iter(ordered.to_batches())))
    key = lambda r: repr(list(r.values()))
    assert sorted(pa.Table.from_batches(folded).to_pylist(), key=key) == sorted(pa.Table.from_batches(whole).to_pylist(), key=key)
    counts = Counter()
    for lang, text in texts:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            counts.update((lang or "und", w) for w in re.findall("[^\x20\x09]+", piece))
    found = {tuple(r["word"].rsplit(" ", 1)): r["n"] for b in whole for r in b.to_pylist() if r["w2"] == 0 and not r["word"].endswith(" ")}
    assert found == {k: n for k, n in counts.items() if n >= 3}


def test_score_is_exact(spark):
    big = 3_037_000_500_123
    df = spark.createDataFrame([(big, big + 7, big * 3), (10, 10, 10), (2_999_999_999_999, 3_000_000_000_000, 3_000_000_000_000)], "a long, l long, r long")
    assert [r[0] for r in df.select(collocations._score(df.a, df.l, df.r)).collect()] == [10**6 * a * a // (l * r) for a, l, r in [tuple(r) for r in df.collect()]]


def test_collocations_on_odd_and_empty_tables(spark, odd_docs, empty_docs):
    texts = [(r.source, r.text) for r in odd_docs.collect()]
    found = collocations.collocations(odd_docs, lang_col="source", min_count=2)
    assert pairs(found, *COLUMNS) == sorted(by_hand(texts, 2), key=repr)
    assert collocations.collocations(empty_docs, lang_col="source").collect() == []
