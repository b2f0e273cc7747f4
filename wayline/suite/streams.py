"""Streams over files derived from the given tables, checked as batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.session import scratch_path, union_rows
from wayline.streaming import jobs
from wayline.suite.base import Data, query
from wayline.suite.documents import HIT_SQL, KEYS, hits

DECAY = 0.99


def _call_per_part(d: Data, parts, label: str, run):
    """Land each part in the same folder and call the stream after each, as a schedule would."""
    path, base = scratch_path(d.spark, label), scratch_path(d.spark, "stream")
    for part in parts:
        part.write.mode("append").parquet(path)
        result = run(jobs.file_stream(d.spark, path, part.schema), base)
    return result


@query("stream_new_documents", f"SELECT DISTINCT city_name, channel, url FROM ({HIT_SQL})")
def _(d: Data):
    rows, noon = hits(d), F.lit("2024-01-15").cast("timestamp_ntz")
    parts = [rows.where(F.col("ts") < noon).select(*KEYS), rows.where(F.col("ts") >= noon).select(*KEYS)]
    return _call_per_part(d, parts, "arrivals", lambda stream, base: jobs.stream_new_documents(stream, base, KEYS))


# A run per day: a score decays once in its own run and once in each later one.
@query("stream_mention_scores", f"""
SELECT user_id AS content_id, round(sum(value * pow({DECAY}, last - day + 1)), 4) AS mention_score FROM (SELECT user_id, value, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
  max(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) OVER () AS last FROM events) GROUP BY 1""")
def _(d: Data):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")
    rows = d.events.select(F.col("user_id").alias("content_id"), day.alias("run_no"), F.col("value").alias("mention_score"))
    # The later half arrives first: the fold does not depend on the order.
    parts = [rows.where("run_no >= 14"), rows.where("run_no < 14")]
    state = _call_per_part(d, parts, "mentions", lambda stream, base: jobs.stream_mention_scores(stream, base, DECAY))
    scores = jobs.scores_at(state, state.agg(F.max("as_of")).scalar(), DECAY)
    return scores.select("content_id", F.round("mention_score", 4).alias("mention_score"))


# The same runs, ranked by users' parity; cents keep equal sums equal.
@query("stream_mention_ranks", f"""
SELECT user_id AS content_id, category, row_number() OVER (PARTITION BY category ORDER BY score DESC, user_id DESC) AS category_rank
FROM (SELECT user_id, user_id % 2 AS category, sum(cents * pow({DECAY}, last - day + 1)) AS score FROM (
  SELECT user_id, CAST(round(value * 100) AS BIGINT) AS cents, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
    max(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) OVER () AS last FROM events) GROUP BY user_id)""")
def _(d: Data):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint")
    rows = d.events.select(F.col("user_id").alias("content_id"), day.alias("run_no"), F.round(F.col("value") * 100).cast("bigint").cast("double").alias("mention_score"))
    categories = rows.select("content_id").distinct().withColumn("category", F.col("content_id") % 2)
    parts = [rows.where("run_no >= 14"), rows.where("run_no < 14")]
    run = lambda stream, base: jobs.stream_mention_scores(stream, base, DECAY, categories)
    return _call_per_part(d, parts, "mentions", run).select("content_id", "category", "category_rank")


# Three snapshots of customers; the latest order before a cut-off is the content.
CUTS = ("1996-01-01", "1998-06-01", "9999-12-31")
SNAP_SQL = " UNION ALL ".join(
    f"SELECT '{cut}' AS snapshot, o_custkey, arg_max(o_orderstatus || o_orderpriority, (o_orderdate, o_orderkey)) AS content FROM orders WHERE o_orderdate < TIMESTAMP '{cut}' GROUP BY 2"
    for cut in CUTS
)


@query("stream_change_feed", f"""
SELECT snapshot, o_custkey, content FROM (SELECT *, lag(content) OVER (PARTITION BY o_custkey ORDER BY snapshot) AS old FROM ({SNAP_SQL}))
WHERE old IS NULL OR old <> content""")
def _(d: Data):
    return _call_per_part(d, _snapshots(d), "snapshots", _feed).select("snapshot", "o_custkey", "content")


# The same snapshots, all landed before the only call.
@query("stream_change_feed_backlog", f"""
SELECT snapshot, o_custkey, content FROM (SELECT *, lag(content) OVER (PARTITION BY o_custkey ORDER BY snapshot) AS old FROM ({SNAP_SQL}))
WHERE old IS NULL OR old <> content""")
def _(d: Data):
    return _call_per_part(d, [union_rows(*_snapshots(d))], "snapshots", _feed).select("snapshot", "o_custkey", "content")


def _snapshots(d: Data):
    return [
        d.orders.where(F.col("o_orderdate") < F.lit(cut).cast("timestamp_ntz"))
        .groupBy("o_custkey")
        .agg(F.max_by(F.concat("o_orderstatus", "o_orderpriority"), F.struct("o_orderdate", "o_orderkey")).alias("content"))
        .select(F.lit(cut).alias("snapshot"), "o_custkey", "content")
        for cut in CUTS
    ]


def _feed(stream, base):
    return jobs.stream_change_feed(stream, base, "o_custkey", "content", "snapshot", F.col("content").isNotNull(), "snapshot")
