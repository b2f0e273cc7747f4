import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from wayline.llm import jaccard_join, source_mixing, toxicity_chain, quality_resampling
from wayline.llm.queries import ORACLES, QUERIES, TOXICITY_CATEGORIES
from wayline.session import materialize

SF = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 11)]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_operator_has_one_query():
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in NAMES) and len(QUERIES) == len(NAMES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    relation = db.execute(ORACLES[name])
    columns = [c[0] for c in relation.description]
    found = QUERIES[name](spark, SF).select(*columns)
    tidy = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert tidy(found.collect()) == tidy(relation.fetchall())


def test_stages_equal_their_operators(spark):
    """Each stage on what the stage before it kept, against the operator's own answer for these rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ids = lambda df, c="doc_id": sorted(r[0] for r in df.select(c).collect())
    kept = []
    for name in names:
        kept.append(docs)
        docs = materialize(stages[name](spark, docs, SF), "stage")
        if name != names[-1]:
            assert docs.columns == kept[0].columns
    kept.append(docs)
    assert ids(kept[1]) == ids(toxicity_chain.toxicity(kept[0], labels, TOXICITY_CATEGORIES).filter("NOT is_toxic"), "id")
    assert ids(kept[2]) == ids(quality_resampling.resample(kept[1], labels).filter("selected"), "id")
    assert ids(kept[3]) == ids(jaccard_join.jaccard_components(kept[2]).filter("id = component"), "id")
    repeats = {r.id: r.repeats for r in source_mixing.mix(kept[3]).collect()}
    assert ids(kept[4]) == sorted(i for i, n in repeats.items() for _ in range(n))
    tokenizers, P = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    for r in kept[5].collect():
        expected = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == expected and r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty_tables(spark, odd_docs, empty_docs, name, stage):
    last = name == corpus_pipeline.STAGES[-1][0]
    rows = stage(spark, odd_docs, SF)
    assert last or rows.columns == odd_docs.columns
    assert rows.count() > 0
    if name == "n-gram Jaccard join":
        assert sorted((r.doc_id for r in rows.collect() if r.doc_id), key=int) == [1, 2, 3, 4, 5, 6, 7, 8, 10]
    assert stage(spark, empty_docs, SF).count() == 0


def test_one_row_stays_of_each_group_when_ids_are_null_or_repeat(spark):
    text = lambda c: " ".join(f"{c}{k}" for k in range(60))
    a, b, c, d = map(text, "abcd")
    docs = [
        (None, a), (None, a), (None, f"{a} more"), (1, f"{b} more"), (None, b),  # a stays once, b as 1
        (2, c), (3, f"{c} more"), (3, d), (4, d), (5, d), (5, f"{d} more"),  # 3 names two groups
        (6, text("e")), (6, f"{text('e')} more"), (6, text("f")), (7, text("f")), (None, ""), (None, ""), (8, None), (8, None),
    ]
    frame = spark.createDataFrame([(*r, "s") for r in docs], "doc_id long, text string, source string").repartition(4)
    kept = [(r.doc_id, (r.text or "")[:2]) for r in corpus_pipeline.drop_near_copies(spark, frame, SF).collect()]
    expected = [(None, "a0"), (1, "b0"), (2, "c0"), (3, "d0"), (6, "e0"), (6, "f0"), (None, ""), (None, ""), (8, "")]
    assert sorted(kept, key=repr) == sorted(expected, key=repr)
