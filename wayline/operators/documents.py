"""Incremental collection of search documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wayline import constants as K
from wayline.operators.ordering import before_first
from wayline.session import union_rows


def required_key(docs: DataFrame, url: str = "url") -> DataFrame:
    """Documents that have a URL."""
    return docs.where(F.coalesce(F.col(url), F.lit("")) != "")


def search_plan(cities: DataFrame, short_name: str = "short_name",
                words: Sequence[str] = K.SEARCH_WORDS, channels: Sequence[str] = K.CHANNELS) -> DataFrame:
    """Every city with every query word and channel, numbered in call order.

    The words and channels are constants inside the row, so this is a
    projection, not a join.
    """
    calls = F.array(
        *[
            F.struct(
                F.lit(i * len(channels) + j).alias("call_no"),
                F.lit(i).alias("query_no"),
                F.lit(word).alias("word"),
                F.lit(channel).alias("channel"),
            )
            for i, word in enumerate(words)
            for j, channel in enumerate(channels)
        ]
    )
    return cities.select("*", F.inline(calls)).withColumn("query", F.concat(F.col(short_name), F.lit(" "), F.col("word")))


def in_folders(ledger: DataFrame, docs: DataFrame, folders: Sequence[str]) -> DataFrame:
    """The part of a ledger that lies in the folders of the documents' own values.

    `folders` are columns that the ledger is stored by. Their values in one run
    are a few cities and channels, and as literals they keep the scan to these folders.
    """
    if not folders:
        return ledger
    found = docs.agg(*[F.collect_set(c).alias(c) for c in folders]).first()
    return ledger.where(reduce(lambda a, b: a & b, [F.col(c).isin(sorted(found[c])) for c in folders]))


def seen_semi_join(docs: DataFrame, ledger: DataFrame, keys: Sequence[str], folders: Sequence[str] = ()) -> DataFrame:
    """Incoming keys that an earlier run has recorded, each once.

    The ledger is filtered by the incoming keys, not the other way round: a
    run's keys are few and can be broadcast, the ledger only grows. `folders`
    names the key columns that the ledger is stored by (see `in_folders`).
    """
    incoming = docs.select(*keys).distinct()
    return in_folders(ledger, docs, folders).select(*keys).join(incoming, list(keys), "left_semi").distinct()


def except_seen(docs: DataFrame, ledger: DataFrame, keys: Sequence[str], folders: Sequence[str] = ()) -> DataFrame:
    """Incoming rows whose key no earlier run has recorded; of a ledger in `folders` only the rows' own are read."""
    return docs.join(seen_semi_join(docs, ledger, keys, folders), list(keys), "left_anti").select(*docs.columns)


def union_channels(channels: dict[str, DataFrame], out: str = "channel") -> DataFrame:
    """Documents of all channels in one frame, labelled by channel."""
    labelled = [df.withColumn(out, F.lit(name)) for name, df in channels.items()]
    return union_rows(*labelled)


def reachable_pages(docs: DataFrame, query_keys: Sequence[str], page: str = "page",
                    page_size: int = K.PAGE_SIZE, max_pages: int | None = None) -> DataFrame:
    """Documents on pages a reader gets to: a short, empty or missing page ends a query.

    All landed pages are read unless `max_pages` says otherwise; how many a
    request may fetch is its caller's business. The end of a query is one
    aggregated row: its first page that is not full.
    """
    keys = list(query_keys)
    landed = docs.where((F.col(page) >= 1) & (F.lit(True) if max_pages is None else F.col(page) <= max_pages))
    full = landed.groupBy(*keys, page).agg(F.count("*").alias("_n")).where(F.col("_n") >= max(1, page_size))
    # Full pages 1, 2, 3, ... stand at their own place of the sorted list up to the first gap.
    unbroken = F.size(F.filter(F.array_sort(F.collect_set(F.col(page).cast("bigint"))), lambda p, i: p == i + 1))
    ends = full.groupBy(*keys).agg((unbroken + 1).alias("_end")).select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_end")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    return landed.join(ends, same, "left").where(F.col(page) <= F.coalesce("_end", F.lit(1))).select(*docs.columns)


def prefix_until_seen(
    docs: DataFrame, ledger: DataFrame, doc_keys: Sequence[str], query_keys: Sequence[str], position: str,
    url: str = "url",
) -> DataFrame:
    """Newest-first documents of each query before the first one seen in an earlier run.

    Later documents are dropped even when new; documents without a URL are
    skipped and do not stop the query.
    """
    usable = required_key(docs, url)
    known = seen_semi_join(usable, ledger, doc_keys)
    return before_first(usable, query_keys, position, usable.join(known, list(doc_keys), "left_semi"))


def doc_dedup_collect(
    docs: DataFrame, keys: Sequence[str], position: Sequence[str], query: str, attributes: Sequence[str]
) -> DataFrame:
    """One row per document: attributes of its first hit, and every hitting query in hit order.

    Hits are ordered query by query, so the list is a run of equal values per
    query. Runs are counted first and expanded last: what is gathered per
    document is one entry per query word, whatever the number of hits.
    """
    pos = F.struct(*position)
    runs = docs.groupBy(*keys, query).agg(
        F.count("*").cast("int").alias("_n"),
        F.min(pos).alias("_first"),
        F.min_by(F.struct(*attributes), pos).alias("_attrs"),
    )
    packed = runs.groupBy(*keys).agg(
        F.min_by("_attrs", "_first").alias("_attrs"),
        F.array_sort(F.collect_list(F.struct("_first", F.col(query).alias("_q"), "_n"))).alias("_runs"),
    )
    expanded = F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["_q"], r["_n"])))
    return packed.select(
        *keys, *[F.col(f"_attrs.{a}").alias(a) for a in attributes], expanded.alias("matched_queries")
    )


def city_collection_stats(docs: DataFrame, city: str = "city_name", channel: str = "channel") -> DataFrame:
    """Document counts per city and channel, per city, and in total."""
    return docs.rollup(city, channel).agg(F.count("*").alias("documents"))
