"""Keyword extraction, frequency and per-city scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wayline import constants as K
from wayline.functions.scoring import diversity_score
from wayline.functions.text import script_words, strip_markup_keep_script
from wayline.session import materialize
from wayline.operators.ordering import top_n_per_group

TOKENS = T.ArrayType(T.StructType([T.StructField("form", T.StringType()), T.StructField("tag", T.StringType())]))

Analyser = Callable[[str], Iterable[tuple[str, str]]]


def analyser_udf(load: Callable[[], Analyser]):
    """Vectorised hook for a part-of-speech analyser.

    `load` runs once per Python worker. A text the analyser cannot handle
    yields no tokens instead of failing the task.
    """

    def safe(analyse: Analyser, text: str | None) -> list[dict]:
        if text is None or not text.strip():
            return []
        try:
            return [{"form": form, "tag": tag} for form, tag in analyse(text)]
        except Exception:
            return []

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        analyse = load()
        for texts in batches:
            yield texts.map(lambda text: safe(analyse, text))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, TOKENS)


def tokenize(
    docs: DataFrame, text: Column, keys: Sequence[str], keep: str = K.HANGUL,
    load: Callable[[], Analyser] | None = None,
) -> DataFrame:
    """One row per token occurrence: `keys`, form, tag. The whole text is read.

    Without an analyser every word of the kept script counts as a proper noun.
    """
    if load:
        return docs.select(*keys, F.inline(analyser_udf(load)(strip_markup_keep_script(text, keep))))
    words = docs.select(*keys, F.explode(script_words(text, keep)).alias("form"))
    return words.withColumn("tag", F.lit(K.PROPER_NOUN_TAGS[0]))


def token_filter(
    tokens: DataFrame, stop: DataFrame | None = None, tags: Sequence[str] = K.PROPER_NOUN_TAGS,
    min_length: int = 2, form: str = "form",
) -> DataFrame:
    """Wanted tags, at least two characters, not on the stop list (one column of words)."""
    kept = tokens
    if "tag" in tokens.columns:
        kept = kept.where(F.col("tag").isin(*tags))
    kept = kept.where(F.length(form) >= min_length)
    if stop is not None:
        words = stop.select(F.col(stop.columns[0]).alias(form)).distinct()
        kept = kept.join(words, form, "left_anti")
    return kept.select(*tokens.columns)


def token_frequency(tokens: DataFrame, keys: Sequence[str], form: str = "form") -> DataFrame:
    """Occurrences, not documents, per key and token."""
    return tokens.groupBy(*keys, form).agg(F.count("*").alias("frequency"))


def channel_pivot(
    freq: DataFrame, city: str, keyword: str, channel: str = "channel", channels: Sequence[str] = K.CHANNELS
) -> DataFrame:
    """Both channels' counts side by side, their total, and whether both occur."""
    first, second = channels
    count = lambda name: F.sum(F.when(F.col(channel) == name, F.col("frequency")).otherwise(0))
    wide = freq.groupBy(city, keyword).agg(
        count(first).alias(f"{first}_frequency"), count(second).alias(f"{second}_frequency")
    )
    a, b = F.col(f"{first}_frequency"), F.col(f"{second}_frequency")
    return wide.withColumns({"total_frequency": a + b, "multi_channel": (a > 0) & (b > 0)})


def min_frequency(df: DataFrame, total: str = "total_frequency", floor: int = K.MIN_FREQUENCY) -> DataFrame:
    return df.where(F.col(total) >= floor)


def max_normalize(
    df: DataFrame, group: str, score: str, out: str = "normalized_score", small_groups: bool = False
) -> DataFrame:
    """Score over the group's maximum, 0 when that is not positive.

    The maximum is an aggregate joined back. It is stored first, so that its
    real size is known and the few maxima go to the rows, not the rows to a
    handful of groups. Groups already cut to their first n (`small_groups`) take a window,
    which reads the input once.
    """
    if small_groups:
        best = F.max(score).over(Window.partitionBy(group))
        return df.withColumn(out, F.when(best > 0, F.col(score) / best).otherwise(0.0))
    top = materialize(df.groupBy(F.col(group).alias("_group")).agg(F.max(score).alias("_max")), "maxima")
    value = F.when(F.col("_max") > 0, F.col(score) / F.col("_max")).otherwise(0.0)
    return df.join(top, F.col(group).eqNullSafe(F.col("_group")), "left").select(*df.columns, value.alias(out))


def keyword_scores(
    docs: DataFrame, text: Column, city: str, channel: str, stop: DataFrame | None = None,
    channels: Sequence[str] = K.CHANNELS, keep: str = K.HANGUL, load=None,
    floor: int = K.MIN_FREQUENCY, top_n: int = K.TOP_N, bonus: float = K.DIVERSITY_BONUS,
) -> DataFrame:
    """Documents to the best keywords of each city with normalised scores.

    Tokens are counted before the stop list is applied, so the anti join and
    every later step see one row per distinct token. Ties are cut by keyword.
    """
    tokens = token_filter(tokenize(docs, text, [city, channel], keep, load))
    freq = token_filter(token_frequency(tokens, [city, channel]), stop).withColumnRenamed("form", "keyword")
    scored = min_frequency(channel_pivot(freq, city, "keyword", channel, channels), floor=floor).withColumn(
        "raw_score", diversity_score(F.col("total_frequency"), F.col("multi_channel"), bonus)
    )
    best = top_n_per_group(scored, [city], [F.col("raw_score").desc(), F.col("keyword").asc()], top_n)
    return max_normalize(best, city, "raw_score", small_groups=True).drop("total_frequency")
