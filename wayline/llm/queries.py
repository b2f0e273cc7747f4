"""The operators bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayline.llm import bm25_search, bpe_codec, collocations, hash_forest, jaccard_join, language_id, license_scan, prefix_trie, quality_resampling, source_mixing, token_counts, toxicity_chain, url_filter
from wayline.llm.checks import ORACLES
from wayline.session import constant_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Token counts above this are reported as over the limit.
TOKEN_LIMIT = 4096
# URL rules, and the host labels whose pages make up the list of blocked URLs.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BLOCKED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> bytes:
    import public_tokenizers

    return bpe_codec.read_file(public_tokenizers.path(name))


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return counted.withColumnRenamed("id", "doc_id").withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.license_scan(table(spark, sf_dir, "documents")))


@query
def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_codec.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return bpe_codec.digests(encoded)


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.split_url(F.col("url"))
    unwanted = F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, BLOCKED_LABELS)))
    listed = pages.filter(unwanted).select(url_filter.canonical(host, path).alias("url"))
    rules = constant_rows(spark, RULES, ("host", "path", "verdict"))
    return url_filter.url_verdicts(pages, rules, listed).withColumnRenamed("id", "page_id")


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


#: The categories that the table of labels has, in chain order: texts unfit for their quality, and toxic ones.
TOXICITY_CATEGORIES = {"unfit": "1 - quality", "toxic": "toxic"}


@query
def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scored = toxicity_chain.toxicity(table(spark, sf_dir, "documents"), labels, TOXICITY_CATEGORIES)
    return scored.withColumnRenamed("id", "doc_id")


@query
def op2_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = quality_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.withColumnRenamed("id", "doc_id")


@query
def op9_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hash_forest.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query
def op3_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25_search.search(docs, docs.filter("doc_id % 100 = 0"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), rebuild=True)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs, F.col("doc_id").isNotNull() & ~held_out)
    found = language_id.predict(docs, model).withColumnRenamed("id", "doc_id")
    return found.withColumn("held_out", held_out)
