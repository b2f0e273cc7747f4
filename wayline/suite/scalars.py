"""Scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import geo, matching, parsing, scoring, text
from wayline.operators.documents import required_key
from wayline.operators.keywords import min_frequency
from wayline.operators.normalize import region_alias_expand
from wayline.suite.base import Data, query

# Raw text cells with the faults real feeds have.
PADDED = """CASE c_mktsegment WHEN 'BUILDING' THEN concat('  ', c_name, ' ')
  WHEN 'MACHINERY' THEN concat(chr(12288), c_name, chr(12288)) WHEN 'FURNITURE' THEN concat(' ', chr(12288), chr(9))
  WHEN 'HOUSEHOLD' THEN concat(chr(9), c_name, chr(10)) ELSE c_name END"""
BLANKS = "concat(' ', chr(9), chr(10), chr(13), chr(12288))"
# Spark's chr() stops at Latin-1, so the wide blank is passed in as text there.
SPARK_PADDED = PADDED.replace("chr(12288)", "'　'")


@query("clean_text", f"SELECT c_custkey, nullif(trim({PADDED}, {BLANKS}), '') AS cleaned FROM customer")
def _(d: Data):
    return d.customer.select("c_custkey", text.clean_text(F.expr(SPARK_PADDED)).alias("cleaned"))


NUMBER_TEXT = """CASE event_type WHEN 'error' THEN 'NaN' WHEN 'signup' THEN props
  WHEN 'view' THEN concat(' ', CAST(value AS {s}), ' ') WHEN 'click' THEN concat('12345', CAST(value AS {s}))
  ELSE CAST(value AS {s}) END"""


@query("safe_decimal", """
SELECT event_id, CASE WHEN event_type IN ('view', 'purchase') THEN value END AS amount FROM events""")
def _(d: Data):
    number = F.expr(NUMBER_TEXT.format(s="STRING"))
    return d.events.select("event_id", parsing.safe_decimal(number).cast("double").alias("amount"))


INT_TEXT = """CASE c_mktsegment WHEN 'BUILDING' THEN substr(c_name, 10) WHEN 'MACHINERY' THEN concat('-', c_custkey)
  WHEN 'FURNITURE' THEN concat(c_custkey, '.0') WHEN 'HOUSEHOLD' THEN concat('  ', c_custkey, ' ') ELSE c_name END"""


@query("safe_int", f"""
SELECT c_custkey, CASE WHEN regexp_matches(trim(t), '^[0-9]+$') THEN TRY_CAST(trim(t) AS BIGINT) END AS number
FROM (SELECT c_custkey, {INT_TEXT} AS t FROM customer)""")
def _(d: Data):
    return d.customer.select("c_custkey", parsing.safe_int(F.expr(INT_TEXT)).alias("number"))


@query("parse_datetime14", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed
FROM orders""")
def _(d: Data):
    stamp = F.expr("""CASE o_orderpriority WHEN '1-URGENT' THEN date_format(o_orderdate, 'yyyy')
      WHEN '2-HIGH' THEN date_format(o_orderdate, 'yyyyMMdd') WHEN '3-MEDIUM' THEN date_format(o_orderdate, 'yyyyMMddHHmmssSSS')
      ELSE date_format(o_orderdate, 'yyyyMMddHHmmss') END""")
    parsed = parsing.parse_datetime14(stamp)
    return d.orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("in_range", "SELECT event_id, CASE WHEN value >= 5 AND value <= 100 THEN value END AS kept FROM events")
def _(d: Data):
    return d.events.select("event_id", parsing.in_range(F.col("value"), 5, 100).alias("kept"))


@query("truncate_text", "SELECT page_id, url[1:24] AS short_url FROM pages")
def _(d: Data):
    return d.pages.select("page_id", text.truncate_text(F.col("url"), 24).alias("short_url"))


@query("content_hash", """
SELECT c_custkey, sha256('v1|' || c_custkey || '|' || c_name || '|' || coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, '') || '|' || c_nationkey) AS content_hash
FROM customer""")
def _(d: Data):
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    fields = [F.col("c_custkey"), F.col("c_name"), segment, F.col("c_nationkey")]
    return d.customer.select("c_custkey", scoring.content_hash(fields, "v1").alias("content_hash"))


# Part type and brand stand for the two code levels.
LEVELS = """CASE p_type WHEN 'ECONOMY' THEN 'FD' WHEN 'STANDARD' THEN 'SH' WHEN 'LARGE' THEN 'HS' WHEN 'MEDIUM' THEN 'NA'
  WHEN 'SMALL' THEN 'LS' ELSE 'ZZ' END AS level1, CASE WHEN p_size <= 10 THEN 'FD05' ELSE p_brand END AS level2"""


@query("classify_category", f"""
SELECT p_partkey, CAST(category AS INTEGER) AS category, CAST(coalesce(category, p_size) AS INTEGER) AS backfilled FROM (
  SELECT p_partkey, p_size, CASE WHEN level1 = 'FD' AND level2 = 'FD05' THEN 2 WHEN level1 = 'FD' THEN 1 WHEN level1 = 'SH' THEN 3
    WHEN level1 IN ('VE', 'HS', 'C01', 'EV') THEN 4 WHEN level1 = 'NA' THEN 5 WHEN level1 IN ('EX', 'LS') THEN 6 WHEN level1 = 'AC' THEN 7 END AS category
  FROM (SELECT p_partkey, p_size, {LEVELS} FROM part))""")
def _(d: Data):
    parts = d.part.selectExpr("p_partkey", "p_size", *[e.strip() for e in _split_levels()])
    level1, level2 = F.col("level1"), F.col("level2")
    return parts.select(
        "p_partkey",
        scoring.classify_category(level1, level2).alias("category"),
        scoring.classify_category(level1, level2, otherwise=F.col("p_size")).alias("backfilled"),
    )


def _split_levels() -> list[str]:
    first, second = LEVELS.split("AS level1,")
    return [f"{first} AS level1", second]


VARIANT = "CASE WHEN p_size <= 15 THEN concat(upper(p_name), ' (', p_brand, ')') WHEN p_size <= 30 THEN concat(p_name, ' 춘천점') ELSE concat('  ', p_name, chr(9), '#!') END"


@query("normalize_name_strict", f"""
SELECT p_partkey, regexp_replace(lower({VARIANT}), '[^0-9a-z가-힣]', '', 'g') AS name FROM part""")
def _(d: Data):
    return d.part.select("p_partkey", text.normalize_name_strict(F.expr(VARIANT)).alias("name"))


@query("normalize_name_ws", f"SELECT p_partkey, regexp_replace(lower({VARIANT}), '\\s+', '', 'g') AS name FROM part")
def _(d: Data):
    return d.part.select("p_partkey", text.normalize_name_ws(F.expr(VARIANT)).alias("name"))


@query("strip_markup_keep_script", """
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&[a-zA-Z]+;|&#[0-9]+;', ' ', 'g'),
  '[^A-Za-zÀ-ÖØ-öø-ÿ ]', ' ', 'g') AS plain FROM pages""")
def _(d: Data):
    return d.pages.select("page_id", text.strip_markup_keep_script(F.col("html"), "A-Za-zÀ-ÖØ-öø-ÿ").alias("plain"))


@query("document_text", """
SELECT conv_id, turn, coalesce(CASE WHEN role <> 'system' THEN role END, '') || ' ' || coalesce(text, '') AS body FROM conversations""")
def _(d: Data):
    title = F.when(F.col("role") != "system", F.col("role"))
    return d.conversations.select("conv_id", "turn", text.document_text(title, F.col("text")).alias("body"))


REGION_NAME = """CASE c_mktsegment WHEN 'BUILDING' THEN concat(c_name, '시') WHEN 'MACHINERY' THEN concat(c_name, '군')
  WHEN 'FURNITURE' THEN concat(c_name, '구') WHEN 'HOUSEHOLD' THEN concat(c_name, '특별자치시') ELSE c_name END"""


@query("strip_region_suffix", f"""
SELECT c_custkey, regexp_replace({REGION_NAME}, '(시|군)$', '') AS city FROM customer""")
def _(d: Data):
    return d.customer.select("c_custkey", text.strip_region_suffix(F.expr(REGION_NAME)).alias("city"))


@query("region_alias_expand", f"""
WITH n AS (SELECT {REGION_NAME} AS name FROM customer)
SELECT name FROM n UNION SELECT regexp_replace(name, '[시군구]$', '') FROM n
UNION SELECT regexp_replace(name, '특별자치시$', '') FROM n UNION SELECT n_name FROM nation""")
def _(d: Data):
    names = d.customer.select(F.expr(REGION_NAME).alias("name"))
    return region_alias_expand(names, "name", d.nation.select("n_name"))


@query("rank_tag", """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN '인기 ' || p_type || ' ' || p_size || '위' END AS tag FROM part""")
def _(d: Data):
    return d.part.select("p_partkey", scoring.rank_tag(F.col("p_type"), F.col("p_size")).alias("tag"))


# One row per user: mentions in whole cents, likes, reviews and a rating.
FEEDBACK_SQL = """SELECT user_id AS content_id, CAST(user_id % 7 + 1 AS INTEGER) AS category,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS mention_score,
  count(CASE WHEN event_type = 'click' THEN 1 END) AS like_count,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS review_count,
  CAST(count(CASE WHEN event_type = 'view' THEN 1 END) AS DOUBLE) * 5 / count(*) AS avg_rating
FROM events GROUP BY user_id"""


def feedback(d: Data):
    kind = lambda name: F.count(F.when(F.col("event_type") == name, 1))
    return d.events.groupBy(F.col("user_id").alias("content_id")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double") / 100).alias("mention_score"),
        kind("click").alias("like_count"),
        kind("purchase").alias("review_count"),
        (kind("view").cast("double") * 5 / F.count("*")).alias("avg_rating"),
    ).withColumn("category", (F.col("content_id") % 7 + 1).cast("int"))


@query("popularity_score", f"""
SELECT content_id, round(mention_score * 5 + like_count * 1 + review_count * 2 + avg_rating * review_count * 0.5, 4) AS popularity_score
FROM ({FEEDBACK_SQL})""")
def _(d: Data):
    score = scoring.popularity_score(*[F.col(c) for c in ("mention_score", "like_count", "review_count", "avg_rating")])
    return feedback(d).select("content_id", F.round(score, 4).alias("popularity_score"))


# Customers placed by balance and nation; those in debt have no coordinates.
PLACE = """c_custkey, CASE WHEN c_acctbal >= 0 THEN 33.0e0 + c_acctbal / 2000.0e0 END AS lat, CASE WHEN c_acctbal >= 0 THEN 124.0e0 + c_nationkey * 0.3e0 END AS lon,
  36.0123e0 AS lat0, 127.4567e0 AS lon0"""
DISTANCE_SQL = """CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 6371000 * acos(least(1.0, cos(radians(lat0)) * cos(radians(lat)) * cos(radians(lon) - radians(lon0))
  + sin(radians(lat0)) * sin(radians(lat)))) END"""


def _placed(d: Data):
    return d.customer.selectExpr(*_split_top(PLACE))


def _split_top(text_: str) -> list[str]:
    """Select list cut at its top-level commas."""
    parts, depth, last = [], 0, 0
    for i, ch in enumerate(text_):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(text_[last:i])
            last = i + 1
    return parts + [text_[last:]]


@query("great_circle_distance", f"SELECT c_custkey, round({DISTANCE_SQL}) AS metres FROM (SELECT {PLACE} FROM customer)")
def _(d: Data):
    metres = geo.great_circle_distance(F.col("lat0"), F.col("lon0"), F.col("lat"), F.col("lon"))
    return _placed(d).select("c_custkey", F.round(metres).alias("metres"))


@query("within_radius", f"""
SELECT c_custkey FROM (SELECT {PLACE} FROM customer) WHERE lat IS NULL OR lon IS NULL OR {DISTANCE_SQL} <= 150000""")
def _(d: Data):
    metres = geo.great_circle_distance(F.col("lat0"), F.col("lon0"), F.col("lat"), F.col("lon"))
    return _placed(d).where(geo.within_radius(metres, F.col("lat"), F.col("lon"), 150000)).select("c_custkey")


@query("run_date_kst", "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS run_date FROM events")
def _(d: Data):
    return d.events.select("event_id", parsing.run_date(F.col("ts")).cast("string").alias("run_date"))


TITLE = """CASE p_type WHEN 'ECONOMY' THEN substr(p_name, 1, 3) WHEN 'LARGE' THEN concat('Old ', p_name, ' House') WHEN 'SMALL' THEN '#!'
  WHEN 'PROMO' THEN upper(p_name) ELSE p_brand END"""


@query("name_containment", f"""
SELECT p_partkey FROM (SELECT p_partkey, regexp_replace(lower(p_name), '[^0-9a-z가-힣]', '', 'g') AS a,
  regexp_replace(lower({TITLE}), '[^0-9a-z가-힣]', '', 'g') AS b FROM part)
WHERE a <> '' AND b <> '' AND (a = b OR (length(a) >= 4 AND (position(a IN b) > 0 OR position(b IN a) > 0)))""")
def _(d: Data):
    names = d.part.select(
        "p_partkey",
        text.normalize_name_strict(F.col("p_name")).alias("a"),
        text.normalize_name_strict(F.expr(TITLE)).alias("b"),
    )
    return names.where(matching.name_containment(F.col("a"), F.col("b"))).select("p_partkey")


ADDRESS = "CASE WHEN c_mktsegment <> 'FURNITURE' THEN concat('Street of nation_', c_nationkey, ' East') END"


@query("ilike_city", f"""
SELECT c_custkey, n_name FROM (SELECT c_custkey, c_nationkey, {ADDRESS} AS address FROM customer) JOIN nation
  ON c_nationkey = n_nationkey WHERE contains(lower(address), lower(n_name))""")
def _(d: Data):
    rows = d.customer.join(d.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.where(matching.address_in_city(F.expr(ADDRESS), F.col("n_name"))).select("c_custkey", "n_name")


@query("required_key", """
SELECT event_id FROM (SELECT event_id, CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE props END AS url FROM events)
WHERE url IS NOT NULL AND url <> ''""")
def _(d: Data):
    url = F.expr("CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE props END")
    return required_key(d.events.withColumn("url", url)).select("event_id")


@query("min_frequency", """
SELECT user_id, event_type, count(*) AS total_frequency FROM events GROUP BY ALL HAVING count(*) >= 12""")
def _(d: Data):
    counts = d.events.groupBy("user_id", "event_type").agg(F.count("*").alias("total_frequency"))
    return min_frequency(counts, floor=12)
