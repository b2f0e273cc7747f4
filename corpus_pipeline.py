"""A training corpus in stages: each takes the documents that the stage before it kept.

Documents need `doc_id`, `text` and `source`; other columns travel along. The
labels that train the first two stages are read from `sf_dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayline.llm import bpe_codec, jaccard_join, quality_resampling, source_mixing, toxicity_chain
from wayline.llm.queries import TOXICITY_CATEGORIES, table, tokenizer_file
from wayline.session import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """What the operators read, and all columns in one, so that no name can clash with theirs."""
    return docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("document"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic. Null and empty texts stay."""
    labels = table(spark, sf_dir, "labels")
    scored = toxicity_chain.toxicity(_packed(docs), labels, TOXICITY_CATEGORIES, keep=("document",))
    return scored.filter("NOT is_toxic").select("document.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their ratio of target to raw text."""
    drawn = quality_resampling.resample(_packed(docs), table(spark, sf_dir, "labels"), keep=("document",))
    return drawn.filter("selected").select("document.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: that with the smallest id, null ids last, then by a hash of the row.

    A row that repeats another in id and text goes. Texts without words all
    stay, but for such repeats of a row with an id.
    """
    # Ids may repeat or be null, so a hash of id and text names the row.
    rows = _packed(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    found = jaccard_join.jaccard_components(rows, "key").withColumnRenamed("id", "key").distinct()
    first = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    named = found.join(rows.select("key", "doc_id").distinct(), "key")
    kept = named.groupBy("component").agg(first.alias("key"), F.max(F.col("n") == 0).alias("lone"))
    rows = rows.select("key", "doc_id", "document").join(kept.select("key", "lone"), "key")
    alone = F.when(F.col("lone") & F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return rows.withColumn("alone", alone).dropDuplicates(["key", "alone"]).select("document.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = source_mixing.mix(_packed(docs), keep=("document",))
    return mixed.select(F.explode(F.array_repeat("document", F.col("repeats").cast("int"))).alias("document")).select("document.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with their count and digests."""
    encoded = bpe_codec.encode_decode(docs, tokenizer_file("byte_bpe_50k.json"))
    return bpe_codec.digests(encoded, keep=("ids",))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither the trained stages nor the tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
