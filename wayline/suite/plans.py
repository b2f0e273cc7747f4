"""Whole jobs on the given tables: entity load, trend run, image recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline import constants as K
from wayline.plans import entity_load as L, trend as T
from wayline.session import scratch_path, union_rows
from wayline.sources.tables import Tables
from wayline.suite.base import Data, query
from wayline.suite.sources import NORMAL_SQL, RAW_SPARK, READY_SQL, order_flags
from wayline.suite.scalars import _split_top

DAY1, DAY2 = "2024-06-01 00:05:00", "2024-06-02 00:05:00"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _new_tables(d: Data) -> Tables:
    return Tables(d.spark, scratch_path(d.spark, "tables"))


# Day 1 lists customers out of debt, day 2 all of them with new images for
# furniture; furniture is listed twice on day 2, the later row wins.
def _two_days(d: Data):
    tables = _new_tables(d)
    raw = d.customer.select("*", *[F.expr(e) for e in _split_top(RAW_SPARK)]).drop(*d.customer.columns[1:3], "c_acctbal")
    first = raw.join(d.customer.where("c_acctbal >= 0").select("c_custkey"), "c_custkey", "left_semi")
    L.daily_entity_load(first.drop("c_mktsegment", "c_custkey"), tables, _at(DAY1), "seq")
    again = raw.where("c_mktsegment = 'FURNITURE'").withColumns(
        {"firstimage": F.concat(F.lit("http://new/"), "c_custkey"), "seq": F.col("seq") + 1_000_000_000_000}
    )
    second = union_rows(raw, again).drop("c_mktsegment", "c_custkey")
    return tables, L.daily_entity_load(second, tables, _at(DAY2), "seq")


LOADED_SQL = f"""SELECT n.*, c_mktsegment = 'FURNITURE' AS twice, c_acctbal >= 0 AS day1 FROM ({NORMAL_SQL}) n JOIN customer ON c_custkey = seq
  WHERE content_id IS NOT NULL AND title IS NOT NULL AND category IS NOT NULL"""


@query("daily_entity_load", f"""
SELECT content_id, title, CASE WHEN twice THEN 'http://new/' || seq ELSE first_image END AS first_image,
  CASE WHEN day1 AND NOT twice THEN '{DAY1}' ELSE '{DAY2}' END AS collected_at, CASE WHEN day1 AND twice THEN '{DAY2}' END AS last_etl_at,
  twice OR first_image IS NOT NULL AS image_pending, NOT twice AND first_image IS NULL AS image_absent FROM ({LOADED_SQL})""")
def _(d: Data):
    tables, _ = _two_days(d)
    state = tables.read("etl_state").select("content_id", "last_etl_at", "image_pending", "image_absent")
    rows = tables.read("entity").hint("merge").join(state, "content_id")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return rows.select("content_id", "title", "first_image", text("collected_at"), text("last_etl_at"), "image_pending", "image_absent")


@query("daily_entity_load_stats", f"""
SELECT (SELECT count(*) FROM ({LOADED_SQL})) AS processed, (SELECT count(*) FROM ({LOADED_SQL}) WHERE twice OR NOT day1) AS changed,
  (SELECT count(*) FROM (SELECT unnest(CASE WHEN c_mktsegment = 'FURNITURE' THEN [1, 2] ELSE [1] END), n.* FROM ({NORMAL_SQL}) n JOIN customer ON c_custkey = seq) WHERE content_id IS NULL OR title IS NULL OR category IS NULL) AS quarantined,
  (SELECT count(*) FROM ({LOADED_SQL}) WHERE twice) AS duplicated""")
def _(d: Data):
    return _two_days(d)[1]


# Orders are entities, their lines the images; some answers failed.
IMAGE_STATUS = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'error' ELSE 'ok' END"


@query("image_recovery", """
SELECT o_orderkey AS content_id, CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' THEN CASE WHEN o_orderstatus = 'F' THEN 'http://old' END
    ELSE url END AS first_image,
  CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' THEN false ELSE url IS NULL END AS image_absent
FROM orders LEFT JOIN (SELECT l_orderkey, 'http://' || min(l_partkey) AS url FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(d: Data):
    tables = _new_tables(d)
    old = F.when(F.col("o_orderstatus") == "F", "http://old")
    ids = d.orders.select(F.col("o_orderkey").alias("content_id"), old.alias("first_image"))
    tables.write("entity", union_rows(tables.read("entity"), ids, allow_missing=True))
    flags = ids.select("content_id", F.lit(True).alias("image_pending"), F.lit(False).alias("image_absent"))
    tables.write("etl_state", union_rows(tables.read("etl_state"), flags, allow_missing=True))
    tables.write("entity_image", ids.where("first_image IS NOT NULL").select("content_id", F.lit(1).alias("order"), F.col("first_image").alias("image_url")))
    lines = d.lineitem.where("l_returnflag <> 'N'").select("l_orderkey", "l_partkey").distinct()
    item = lambda p: F.create_map(F.lit("originimgurl"), F.concat(F.lit("http://"), p.cast("string")), F.lit("smallimageurl"), F.lit(""))
    found = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("_ps"))
    answers = d.orders.join(found, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("content_id"), F.expr(IMAGE_STATUS).alias("status"),
        F.coalesce(F.transform("_ps", item), F.array().cast("array<map<string,string>>")).alias("items"),
    )
    L.image_recovery(answers, tables, _at(DAY2), limit=None)
    state = tables.read("etl_state").select("content_id", "image_absent")
    return tables.read("entity").select("content_id", "first_image").hint("merge").join(state, "content_id")


# The ledger rows that the two days leave.
COUNTS_SQL = "'[{{\"processed\":' || {p} || ',\"changed\":' || {c} || ',\"quarantined\":' || {q} || ',\"duplicated\":' || {d} || '}}]'"
BAD_SQL = f"SELECT c_mktsegment = 'FURNITURE' AS twice, c_acctbal >= 0 AS day1 FROM ({NORMAL_SQL}) n JOIN customer ON c_custkey = seq WHERE content_id IS NULL OR title IS NULL OR category IS NULL"


@query("job_runs", f"""
WITH good AS ({LOADED_SQL}), bad AS ({BAD_SQL}),
n AS (SELECT (SELECT count(*) FROM good WHERE day1) AS g1, (SELECT count(*) FROM bad WHERE day1) AS b1, (SELECT count(*) FROM good) AS g2,
  (SELECT count(*) FROM good WHERE twice OR NOT day1) AS c2, (SELECT count(*) FROM good WHERE twice) AS d2, (SELECT count(*) + count(*) FILTER (twice) FROM bad) AS b2)
SELECT 'daily_entity_load' AS dag_id, '{DAY1}' AS run_id, 'success' AS status, {COUNTS_SQL.format(p='g1', c='g1', q='b1', d='0')} AS stats FROM n
UNION ALL SELECT 'daily_entity_load', '{DAY2}', 'success', {COUNTS_SQL.format(p='g2', c='c2', q='b2', d='d2')} FROM n""")
def _(d: Data):
    tables, _ = _two_days(d)
    return tables.read("etl_run").select("dag_id", "run_id", "status", "stats")


# Orders with work due for all four kinds of responses at once.
@query("enrich_all", """
SELECT o_orderkey AS content_id, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' THEN 'h' || o_custkey END AS homepage,
  CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS overview,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'i' || o_custkey END AS infocenter,
  CASE WHEN o_totalprice > 100000 AND o_orderpriority <> '5-LOW' THEN CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE '[{"a":"' || o_custkey || '"}]' END END AS detail_info,
  CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 'http://' || o_custkey END AS first_image,
  o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' AS detail_common_pending, false AS detail_intro_pending, false AS detail_info_pending, false AS image_pending,
  o_orderstatus = 'O' AND o_totalprice <= 200000 AS image_absent, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 2 ELSE 0 END AS images
FROM orders""")
def _(d: Data):
    tables = _new_tables(d)
    low = F.col("o_orderpriority") == "5-LOW"
    entities = d.orders.select(F.col("o_orderkey").alias("content_id"), F.when(~low, "12").alias("content_type_id"))
    tables.write("entity", union_rows(tables.read("entity"), entities, allow_missing=True))
    flags = d.orders.select(
        F.col("o_orderkey").alias("content_id"), (F.col("o_orderstatus") != "F").alias("detail_common_pending"), F.lit(True).alias("detail_intro_pending"),
        (F.col("o_totalprice") > 100000).alias("detail_info_pending"), (F.col("o_orderstatus") == "O").alias("image_pending"), F.lit(False).alias("image_absent"),
    )
    tables.write("etl_state", union_rows(tables.read("etl_state"), flags, allow_missing=True))
    item = lambda **fields: F.create_map(*[c for k, v in fields.items() for c in (F.lit(k), v)])
    none = F.array().cast("array<map<string,string>>")
    label = lambda prefix: F.concat(F.lit(prefix), F.col("o_custkey").cast("string"))
    answer = lambda status, items: d.orders.select(F.col("o_orderkey").alias("content_id"), status.alias("status"), items.alias("items"))
    ok = F.lit("ok")
    L.enrich_all({
        "detail_common": answer(F.when(F.col("o_orderpriority") == "1-URGENT", "error").otherwise("ok"), F.array(item(homepage=label(" h"), overview=F.col("o_orderpriority")))),
        "detail_intro": answer(ok, F.array(item(infocenter=label("i"), parking=F.lit(" ")))),
        "detail_info": answer(ok, F.when(F.col("o_orderstatus") == "P", none).otherwise(F.array(item(a=label(""))))),
        "image": answer(ok, F.when(F.col("o_totalprice") > 200000, F.array(item(originimgurl=label("http://")), item(originimgurl=F.lit(" ")), item(smallimageurl=label("s")))).otherwise(none)),
    }, tables, _at(DAY2), limit=None)
    numbers = tables.read("entity_image").groupBy("content_id").agg(F.max("order").alias("images"))
    state = tables.read("etl_state").select("content_id", *[f"{k}_pending" for k in L.KINDS], "image_absent")
    rows = tables.read("entity").hint("merge").join(state, "content_id").hint("merge").join(numbers, "content_id", "left")
    return rows.select(
        "content_id", "homepage", "overview", "infocenter", "detail_info", "first_image", *[f"{k}_pending" for k in L.KINDS], "image_absent",
        F.coalesce("images", F.lit(0)).alias("images"),
    )


# Feedback on customers: open orders are likes, filled ones reviews, some of them deleted.
@query("refresh_feedback", """
SELECT c_custkey AS content_id, CAST(coalesce(likes, 0) AS INTEGER) AS like_count, CAST(coalesce(reviews, 0) AS INTEGER) AS review_count,
  coalesce(CAST((sums * 200 + reviews) // (2 * reviews) AS DOUBLE) / 100, 0) AS avg_rating FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS likes FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS reviews, CAST(sum(o_orderkey % 5 + 1) AS BIGINT) AS sums FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' GROUP BY 1) b ON b.o_custkey = c_custkey""")
def _(d: Data):
    from wayline.plans.landing import refresh_feedback

    tables = _new_tables(d)
    fill = lambda name, rows: tables.write(name, union_rows(tables.read(name), rows, allow_missing=True))
    fill("entity", d.customer.select(F.col("c_custkey").alias("content_id")))
    given = d.orders.select(F.col("o_custkey").alias("content_id"), F.col("o_orderkey").alias("user_id"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    fill("entity_like", given.where("o_orderstatus = 'O'").select("user_id", "content_id"))
    fill("review", given.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("review_id"), "content_id", "user_id", (F.col("o_orderkey") % 5 + 1).cast("int").alias("rating"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_deleted"),
    ))
    refresh_feedback(tables)
    return tables.read("entity").select("content_id", "like_count", "review_count", F.col("avg_rating").cast("double").alias("avg_rating"))


# Listed codes with blanks and repeats, loaded twice; the second time nations have other names.
@query("sync_codes", """
SELECT 'area' AS kind, CAST(r_regionkey AS VARCHAR) AS code, r_name AS name, CAST(NULL AS VARCHAR) AS parent FROM region
UNION ALL SELECT 'district', CAST(n_nationkey AS VARCHAR), n_name || '*', CAST(n_regionkey AS VARCHAR) FROM nation
UNION ALL SELECT 'category', p_brand, max(p_type), NULL FROM part GROUP BY p_brand
UNION ALL SELECT 'category', p_brand || '-' || p_size, max(p_name), p_brand FROM part GROUP BY p_brand, p_size""")
def _(d: Data):
    from wayline.plans.landing import sync_codes

    tables = _new_tables(d)
    text = lambda c: F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" "))
    areas = d.region.select(text("r_regionkey").alias("code"), F.col("r_name").alias("name"))
    areas = union_rows(areas, areas.limit(1).select(F.lit(" ").alias("code"), "name"))
    none = F.lit(None).cast("string")
    top = d.part.select(F.col("p_brand").alias("code"), F.col("p_type").alias("name"), F.lit(1).alias("depth"), none.alias("level1"), none.alias("level2"))
    below = d.part.select(
        F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("code"), F.col("p_name").alias("name"), F.lit(2).alias("depth"), F.col("p_brand").alias("level1"), none.alias("level2")
    )
    for mark in ("", "*"):
        districts = d.nation.select(F.col("n_regionkey").cast("string").alias("area_code"), text("n_nationkey").alias("code"), F.concat("n_name", F.lit(mark)).alias("name"))
        sync_codes(areas, districts, union_rows(top, below), tables)
    row = lambda kind, table, code, parent: tables.read(table).select(F.lit(kind).alias("kind"), F.col(code).alias("code"), "name", parent.alias("parent"))
    return union_rows(
        row("area", "area_code", "area_code", none), row("district", "sigungu_code", "sigungu_code", F.col("area_code")),
        row("category", "category", "code", F.col("parent_code")),
    )


@query("notify_ready", f"SELECT count(*) AS accepted FROM ({READY_SQL})")
def _(d: Data):
    tables = _new_tables(d)
    tables.write("etl_state", union_rows(tables.read("etl_state"), order_flags(d), allow_missing=True))
    return L.notify(tables, "run-1", scratch_path(d.spark, "outbox"), limit=None)


# Parts are search documents, place results and entities of their brand's city.
WORDS = "SELECT p_partkey, p_brand, CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'SMALL') THEN 'blog' ELSE 'cafe' END AS channel, p_name, lower(p_type) AS t FROM part"
TREND_SQL = f"""
WITH docs AS ({WORDS}),
tok AS (SELECT p_brand AS city, channel, unnest(string_split(p_name, ' ')) AS kw FROM docs),
freq AS (SELECT city, kw, count(*) FILTER (channel = 'blog') AS b, count(*) FILTER (channel = 'cafe') AS c FROM tok WHERE kw NOT IN (SELECT lower(p_type) FROM part) GROUP BY ALL),
sc AS (SELECT *, CASE WHEN b > 0 AND c > 0 THEN (b + c) * 1.3e0 ELSE CAST(b + c AS DOUBLE) END AS raw FROM freq WHERE b + c >= 3),
top AS (SELECT city, kw, raw / max(raw) OVER (PARTITION BY city) AS norm FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY raw DESC, kw) AS rn FROM sc) WHERE rn <= 20),
cand AS (SELECT p_brand AS city, string_split(p_name, ' ')[2] AS kw, p_name AS place, p_size AS sz, row_number() OVER (PARTITION BY p_brand, string_split(p_name, ' ')[2] ORDER BY p_partkey) AS rn FROM part WHERE p_type <> 'PROMO'),
hit AS (SELECT top.city, top.kw, norm, place, 127.0013e0 + sz * 0.004e0 AS lon, 37.0011e0 + sz * 0.0037e0 AS lat FROM top JOIN cand ON top.city = cand.city AND top.kw = cand.kw WHERE rn = 1),
ent AS (SELECT p_partkey, p_brand, p_name, p_size, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'LARGE' THEN 3 WHEN 'MEDIUM' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS category,
  127.0e0 + p_size * 0.004e0 AS x, 37.0e0 + p_size * 0.0037e0 AS y FROM part),
pair AS (SELECT hit.*, p_partkey, row_number() OVER (PARTITION BY hit.city, kw ORDER BY round(dist), p_partkey) AS rn FROM (
  SELECT hit.*, p_partkey, 6371000 * acos(least(1.0, cos(radians(lat)) * cos(radians(y)) * cos(radians(x) - radians(lon)) + sin(radians(lat)) * sin(radians(y)))) AS dist
  FROM hit JOIN ent ON contains(lower('1 ' || p_brand || ' Road'), lower(city)) AND place = p_name) hit WHERE dist <= 1000),
men AS (SELECT p_partkey AS content_id, sum(norm) * 0.99e0 AS m FROM pair WHERE rn = 1 GROUP BY 1),
score AS (SELECT content_id, m, category, m * 5 + p_size * 1 + 2 * 2 + 4.5 * 2 * 0.5 AS s FROM men JOIN ent ON content_id = p_partkey)
SELECT content_id, round(m, 6) AS mention_score, round(s, 4) AS popularity_score, CAST(rn AS INTEGER) AS category_rank,
  CASE WHEN rn <= 10 THEN '인기 ' || {[name for _, name in sorted(K.CATEGORY_NAMES)]}[category] || ' ' || rn || '위' END AS rank_tag
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s DESC, content_id DESC) AS rn FROM score)"""


@query("hourly_trend", TREND_SQL)
def _(d: Data):
    from wayline.operators.normalize import ordinal_assign

    tables = _new_tables(d)
    x, y = F.col("p_size") * 0.004, F.col("p_size") * 0.0037
    category = F.expr("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'LARGE' THEN 3 WHEN 'MEDIUM' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END")
    entities = d.part.select(
        F.col("p_partkey").alias("content_id"), F.col("p_name").alias("title"), F.concat(F.lit("1 "), "p_brand", F.lit(" Road")).alias("addr1"),
        (x + 127.0).cast("decimal(13,10)").alias("map_x"), (y + 37.0).cast("decimal(13,10)").alias("map_y"), category.alias("category"),
        F.col("p_size").alias("like_count"), F.lit(2).alias("review_count"), F.lit(4.5).cast("decimal(3,2)").alias("avg_rating"),
    )
    tables.write("entity", union_rows(tables.read("entity"), entities, allow_missing=True))

    channel = F.when(F.col("p_type").isin("ECONOMY", "LARGE", "SMALL"), "blog").otherwise("cafe")
    found = d.part.select(
        F.col("p_brand").alias("city_name"), channel.alias("channel"), F.lit("tour").alias("query"), F.lit(0).alias("query_no"),
        F.concat("p_brand", channel).alias("_list"), "p_partkey", F.col("p_name").alias("title"), F.lower("p_type").alias("contents"),
    )
    placed = ordinal_assign(found, "_list", [F.col("p_partkey").desc()], "rn")
    docs = placed.select(
        "city_name", "channel", "query", "query_no", (F.floor((F.col("rn") - 1) / 50) + 1).cast("int").alias("page"),
        ((F.col("rn") - 1) % 50).cast("int").alias("idx"), F.concat(F.lit("u"), "p_partkey").alias("url"),
        F.lit("2024-06-01T00:00:00+09:00").alias("datetime"), "title", "contents",
    )
    code = F.when(F.col("p_type") == "PROMO", "MT1").otherwise("AT4")
    candidates = d.part.select(
        F.col("p_brand").alias("city_name"), F.split("p_name", " ")[1].alias("keyword"), F.col("p_partkey").alias("pos"),
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("place_name"), code.alias("category_group_code"),
        F.lit("").alias("category_group_name"), F.lit("").alias("road_address_name"), F.concat(F.lit("1 "), "p_brand").alias("address_name"),
        F.lit("").alias("phone"), (x + 127.0013).cast("string").alias("x"), (y + 37.0011).cast("string").alias("y"),
    )
    cities = d.part.select(F.col("p_brand").alias("city_name"), F.col("p_brand").alias("short_name")).distinct()
    stop = d.part.select(F.lower("p_type").alias("word")).distinct()
    T.hourly_trend(
        docs, candidates, tables, cities, stop, "run-0001", _at(DAY1), keep="a-z",
        collect_options={"page_size": 50},
    )
    scores = tables.read("popularity")
    return scores.select(
        "content_id", F.round("mention_score", 6).alias("mention_score"), F.round("popularity_score", 4).alias("popularity_score"),
        "category_rank", "rank_tag",
    )
