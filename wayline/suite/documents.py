"""Incremental document collection; events stand for search results."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import documents as D
from wayline.operators.merge import insert_ignore
from wayline.suite.base import Data, query

# City, channel, query and URL of an event. Many events share a URL.
HIT_SQL = """SELECT event_id, ts, event_type AS city_name, CASE WHEN value < 20 THEN 'blog' ELSE 'cafe' END AS channel,
  CASE WHEN value < 10 THEN 0 WHEN value < 40 THEN 1 ELSE 2 END AS query_no, CASE WHEN value < 10 THEN 'tour' WHEN value < 40 THEN 'sight' ELSE 'food' END AS query,
  CASE WHEN value < 0.5 THEN '' ELSE 'http://x/' || props END AS url, user_id, value FROM events"""
KEYS = ["city_name", "channel", "url"]
QUERY = ["city_name", "channel", "query"]


def hits(d: Data):
    v = F.col("value")
    return d.events.select(
        "event_id", "ts", F.col("event_type").alias("city_name"),
        F.when(v < 20, "blog").otherwise("cafe").alias("channel"),
        F.when(v < 10, 0).when(v < 40, 1).otherwise(2).alias("query_no"),
        F.when(v < 10, "tour").when(v < 40, "sight").otherwise("food").alias("query"),
        F.when(v < 0.5, "").otherwise(F.concat(F.lit("http://x/"), "props")).alias("url"),
        "user_id", "value",
    )


EARLIER = "ts < TIMESTAMP '2024-01-05'"
LATER = "ts >= TIMESTAMP '2024-01-05'"


def _split(d: Data):
    rows = hits(d)
    cut = F.lit("2024-01-05").cast("timestamp_ntz")
    return rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)


@query("seen_semi_join", f"""
SELECT DISTINCT city_name, channel, url FROM ({HIT_SQL}) WHERE {LATER}
INTERSECT SELECT city_name, channel, url FROM ({HIT_SQL}) WHERE {EARLIER}""")
def _(d: Data):
    ledger, new = _split(d)
    return D.seen_semi_join(new, ledger, KEYS)


@query("except_seen", f"""
SELECT event_id, city_name, channel, url FROM ({HIT_SQL}) WHERE {LATER}
AND (city_name, channel, url) NOT IN (SELECT (city_name, channel, url) FROM ({HIT_SQL}) WHERE {EARLIER})""")
def _(d: Data):
    ledger, new = _split(d)
    return D.except_seen(new.select("event_id", *KEYS), ledger, KEYS)


@query("insert_ignore", f"""
SELECT city_name, channel, url, min(event_id) AS event_id FROM ({HIT_SQL}) WHERE {LATER}
AND (city_name, channel, url) NOT IN (SELECT (city_name, channel, url) FROM ({HIT_SQL}) WHERE {EARLIER}) GROUP BY ALL""")
def _(d: Data):
    ledger, new = _split(d)
    return insert_ignore(ledger, new.select(*KEYS, "event_id"), KEYS, order_by=["event_id"])


# Newest first; rare high values and everything before the 10th were seen before.
SEEN_URL = "CASE WHEN value < 0.5 THEN NULL ELSE 'e' || event_id END"
SEEN = "(ts < TIMESTAMP '2024-01-10' OR value > 200)"


@query("prefix_until_seen", f"""
WITH h AS (SELECT *, {SEEN_URL} AS u FROM ({HIT_SQL})),
s AS (SELECT city_name, channel, query, max(ts) AS stop FROM h WHERE {SEEN} AND u IS NOT NULL GROUP BY ALL)
SELECT h.event_id, h.city_name, h.channel, h.query FROM h LEFT JOIN s USING (city_name, channel, query) WHERE u IS NOT NULL AND (stop IS NULL OR h.ts > stop)""")
def _(d: Data):
    docs = hits(d).withColumns(
        {"url": F.when(F.col("value") >= 0.5, F.concat(F.lit("e"), "event_id")), "pos": -F.unix_micros(F.col("ts").cast("timestamp"))}
    )
    ledger = docs.where("ts < timestamp_ntz'2024-01-10 00:00:00' OR value > 200").where("url IS NOT NULL").select(*KEYS)
    kept = D.prefix_until_seen(docs.select("event_id", "pos", "query", *KEYS), ledger, KEYS, QUERY, "pos")
    return kept.select("event_id", "city_name", "channel", "query")


# Pages of a listing per user: page = day block, so pages are full, short or missing.
@query("reachable_pages", """
WITH p AS (SELECT event_id, user_id, CAST(day(ts) AS INTEGER) AS page FROM events),
n AS (SELECT user_id, page, count(*) AS n FROM p GROUP BY ALL),
f AS (SELECT a.user_id, a.page FROM (SELECT DISTINCT user_id, page FROM p) a
  LEFT JOIN n b ON a.user_id = b.user_id AND b.page < a.page AND b.n >= 2 GROUP BY ALL HAVING count(b.page) = a.page - 1)
SELECT event_id, user_id, page FROM p SEMI JOIN f USING (user_id, page)""")
def _(d: Data):
    docs = d.events.select("event_id", "user_id", F.dayofmonth("ts").alias("page"))
    return D.reachable_pages(docs, ["user_id"], "page", page_size=2)


@query("doc_dedup_collect", f"""
WITH h AS (SELECT *, row_number() OVER (PARTITION BY city_name, channel, url ORDER BY query_no, event_id) AS rn FROM ({HIT_SQL}))
SELECT city_name, channel, url, max(CASE WHEN rn = 1 THEN user_id END) AS user_id, max(CASE WHEN rn = 1 THEN event_id END) AS event_id,
  array_to_string(list(query ORDER BY rn), '|') AS matched_queries FROM h GROUP BY ALL""")
def _(d: Data):
    packed = D.doc_dedup_collect(hits(d), KEYS, ["query_no", "event_id"], "query", ["user_id", "event_id"])
    return packed.withColumn("matched_queries", F.array_join("matched_queries", "|"))


@query("union_channels", f"""
SELECT city_name, channel, count(*) AS n FROM ({HIT_SQL}) GROUP BY ALL""")
def _(d: Data):
    rows = hits(d)
    parts = {name: rows.where(F.col("channel") == name).drop("channel") for name in ("blog", "cafe")}
    return D.union_channels(parts).groupBy("city_name", "channel").agg(F.count("*").alias("n"))


@query("city_collection_stats", f"""
SELECT city_name, channel, count(*) AS documents FROM ({HIT_SQL}) GROUP BY ROLLUP (city_name, channel)""")
def _(d: Data):
    return D.city_collection_stats(hits(d))


@query("search_plan_cross", """
SELECT c_custkey, CAST(q * 2 + c AS INTEGER) AS call_no, ['blog', 'cafe'][c + 1] AS channel, c_name || ' ' || ['여행', '관광', '맛집'][q + 1] AS query
FROM customer, range(3) AS a(q), range(2) AS b(c)""")
def _(d: Data):
    plan = D.search_plan(d.customer.select("c_custkey", "c_name"), short_name="c_name")
    return plan.select("c_custkey", "call_no", "channel", "query")
