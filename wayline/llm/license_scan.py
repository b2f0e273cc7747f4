"""License notices: an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayline.llm.common import ascii_lower
from wayline.session import constant_rows

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a block, and from one block's start to the next; what is at most `BLOCK - STRIDE` long lies whole in a block.
BLOCK, STRIDE = 64, 32


class Template(NamedTuple):
    """A block matches when it has `needed` of the template's distinct words; a phrase's must also stand consecutively."""

    label: str
    words: tuple[str, ...]
    threshold: float = 0.8
    phrase: bool = False

    @property
    def needed(self) -> int:
        return max(1, ceil(self.threshold * len(set(self.words)) - 1e-9))


# Phrases with their labels, and short notices.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
NOTICES = (
    ("mit-notice", "released under the mit license"),
    ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("bsd-conditions", "redistribution and use in source and binary forms with or without modification are permitted"),
)
TEMPLATES = tuple(Template(label, tuple(text.split()), 1.0, True) for label, text in PHRASES) + tuple(
    Template(label, tuple(text.split())) for label, text in NOTICES
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def token_order(docs: DataFrame, text_col: str, templates: Sequence[Template]) -> list[str]:
    """The templates' words, rarest in the documents first; the templates bound what comes to the driver."""
    vocabulary = sorted({w for t in templates for w in t.words})
    counted = (
        docs.select(F.explode(F.array_intersect(words_of(docs[text_col]), _strings(vocabulary))).alias("word"))
        .groupBy("word").count().collect()
    )
    frequency = {r["word"]: r["count"] for r in counted}
    return sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))


def _index(spark: SparkSession, templates: Sequence[Template], order: Sequence[str]) -> DataFrame:
    """Prefix index: a block with `needed` words of a template has one of the first `size - needed + 1` in order."""
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for t in templates:
        ordered = sorted(set(t.words), key=rank.__getitem__)
        prefix = ordered[: len(ordered) - t.needed + 1]
        rows += [(token, t.label, t.phrase, k, len(ordered), t.needed, " ".join(ordered), " ".join(t.words), len(prefix))
                 for k, token in enumerate(prefix)]
    names = ("token", "label", "phrase", "place", "size", "needed", "ordered", "text", "prefix")
    return constant_rows(spark, rows, names).withColumns(
        {"ordered": F.split("ordered", " "), "text": F.split("text", " ")}
    )


def license_scan(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id`, `n_words` and `matches` of every document.

    `matches`: one struct (label, phrase, containment, start, places) for each
    block and template that meet the template's threshold; `start` is the
    block's first word, `places` the words (from 0) at which a phrase stands;
    phrases without a place in the block's own part are left out.

    Null texts have no words. Null ids and repeated rows are kept, one result
    row each; further columns are ignored, whatever their names. A template
    longer than `BLOCK - STRIDE` words raises ValueError.
    """
    if any(len(t.words) > BLOCK - STRIDE or not t.words for t in templates):
        raise ValueError("a template must have from one word to BLOCK - STRIDE words")
    spark = docs.sparkSession
    order = token_order(docs, text_col, templates)
    index = _index(spark, templates, order)
    rank = {w: k for k, w in enumerate(order)}
    signs = sorted({w for t in templates for w in sorted(set(t.words), key=rank.__getitem__)[: len(set(t.words)) - t.needed + 1]})

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), words_of(docs[text_col]).alias("words")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STRIDE))
    blocks = F.when(F.arrays_overlap("words", _strings(signs)), F.filter(
        F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice("words", s + 1, F.lit(BLOCK)).alias("block"))),
        lambda b: F.arrays_overlap(b["block"], _strings(signs)),
    ))
    rows = rows.select("row", "id", F.size("words").cast("long").alias("n_words"), F.explode_outer(blocks).alias("b"))
    known = F.array_intersect(_strings(order), F.col("b.block"))  # the block's template words in global order
    rows = rows.select("row", "id", "n_words", "b.start", "b.block", known.alias("known"))
    rows = rows.withColumn("token", F.explode_outer(F.array_intersect("known", _strings(signs))))
    # The index is a constant: a few rows for each template.
    pairs = rows.join(F.broadcast(index), "token", "left")

    place_in_block = F.array_position("known", F.col("token")) - 1
    first_common = F.get(F.array_intersect(F.slice("ordered", F.lit(1), F.col("prefix")), F.col("known")), F.lit(0))
    fits = (
        (F.col("token") == first_common)  # each block and template once
        & (F.size("known") >= F.col("needed"))
        & (1 + F.least(F.col("size") - F.col("place") - 1, F.size("known") - place_in_block - 1) >= F.col("needed"))
    )
    shared = F.size(F.array_intersect("ordered", "known"))
    ends = F.least(F.lit(STRIDE), F.size("block") - F.size("text") + 1)
    own_starts = F.when(ends > 0, F.sequence(F.lit(0), ends - 1)).otherwise(F.array().cast("array<int>"))
    places = F.transform(
        F.filter(own_starts, lambda s: F.slice("block", s + 1, F.size("text")) == F.col("text")),
        lambda s: (s + F.col("start")).cast("long"),
    )
    pairs = pairs.withColumn("shared", F.when(fits, shared)).withColumn(
        "places", F.when(F.col("phrase") & (F.col("shared") >= F.col("needed")), places)
    )
    match = F.when(
        (F.col("shared") >= F.col("needed")) & (~F.col("phrase") | (F.size("places") > 0)),
        F.struct("label", "phrase", (F.col("shared") / F.col("size")).alias("containment"),
                 F.col("start").cast("long").alias("start"), "places"),
    )
    return pairs.groupBy("row", "id", "n_words").agg(F.collect_list(match).alias("matches")).drop("row")


def summary(scanned: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """Counts, labels and the best containment of every document."""
    base = F.filter("matches", lambda m: m["phrase"])
    places = F.flatten(F.transform(base, lambda m: m["places"]))
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return scanned.select(
        F.col("id").alias(id_name), "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )
