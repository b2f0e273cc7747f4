"""Snapshots, pages, nested JSON, stored tables and raw-item normalisation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wayline.operators import normalize as N
from wayline.operators.ordering import distributed_row_number
from wayline.operators.queues import outbox_batches, ready_filter
from wayline.plans.landing import land_listing
from wayline.session import scratch_path, union_rows
from wayline.sources import pages as P, snapshots as S, trend_json as J
from wayline.sources.outbox import write_outbox
from wayline.sources.tables import Tables, code_table_scan
from wayline.suite.base import Data, query
from wayline.suite.scalars import _split_top

DAY = date(2024, 1, 1)

# Customers as raw listing items: text only, with padding, bad ids, blank
# titles, coordinates out of range and unsupported codes.
RAW = """c_custkey AS seq, CASE WHEN c_acctbal < -900 THEN concat('x', c_custkey) ELSE concat(' ', c_custkey, ' ') END AS contentid,
CASE WHEN c_nationkey = 5 THEN '   ' ELSE concat(' ', c_name) END AS title,
CASE WHEN c_acctbal > 0 THEN concat('Road NATION_', c_nationkey) END AS addr1,
CASE WHEN c_acctbal > 9000 THEN 'NaN' ELSE concat(CAST(120 + c_nationkey AS {s}), '.5') END AS mapx,
CASE WHEN c_acctbal > 8000 THEN 'north' ELSE concat(CAST(30 + c_nationkey AS {s}), '.25') END AS mapy,
CASE WHEN c_acctbal > 5000 THEN '6' ELSE '-6' END AS mlevel,
CASE c_mktsegment WHEN 'BUILDING' THEN 'FD' WHEN 'MACHINERY' THEN ' SH ' WHEN 'FURNITURE' THEN 'NA' WHEN 'HOUSEHOLD' THEN 'AC' ELSE 'ZZ' END AS {q}lclsSystm1{q},
CASE WHEN c_nationkey < 10 THEN 'FD05' ELSE 'FD01' END AS {q}lclsSystm2{q},
CASE WHEN c_acctbal > 2000 THEN concat('http://img/', c_custkey) ELSE '' END AS firstimage,
CASE WHEN c_acctbal > 1000 THEN '20240102030405' WHEN c_acctbal > 0 THEN '2024' ELSE '20231231' END AS createdtime"""
RAW_SPARK = RAW.format(s="STRING", q="`")
RAW_SQL = f"SELECT {RAW.format(s='VARCHAR', q='')} FROM customer"

NORMAL_SQL = f"""SELECT seq, CASE WHEN regexp_matches(trim(contentid), '^[0-9]+$') THEN CAST(trim(contentid) AS BIGINT) END AS content_id,
  nullif(trim(title), '') AS title, addr1,
  CASE WHEN TRY_CAST(mapx AS DECIMAL(13,10)) BETWEEN 124 AND 132 THEN CAST(TRY_CAST(mapx AS DECIMAL(13,10)) AS DOUBLE) END AS map_x,
  CASE WHEN TRY_CAST(mapy AS DECIMAL(13,10)) BETWEEN 33 AND 39 THEN CAST(TRY_CAST(mapy AS DECIMAL(13,10)) AS DOUBLE) END AS map_y,
  CASE WHEN mlevel = '6' THEN 6 END AS map_level,
  CASE trim(lclsSystm1) WHEN 'FD' THEN CASE lclsSystm2 WHEN 'FD05' THEN 2 ELSE 1 END WHEN 'SH' THEN 3 WHEN 'NA' THEN 5 WHEN 'AC' THEN 7 END AS category,
  nullif(firstimage, '') AS first_image,
  CASE WHEN createdtime = '20240102030405' THEN '2024-01-02 03:04:05' WHEN createdtime = '20231231' THEN '2023-12-31 00:00:00' END AS created_time,
  sha256('v4-drop-legacy-area-code|' || contentid || '||' || title || '|' || coalesce(addr1, '') || '|||' || mapx || '|' || mapy || '|' || mlevel
    || '||||' || lclsSystm1 || '|' || lclsSystm2 || '||' || firstimage || '|') AS content_hash
FROM ({RAW_SQL})"""


def raw_items(d: Data):
    return d.customer.selectExpr(*_split_top(RAW_SPARK))


@query("normalize_entity", f"SELECT * FROM ({NORMAL_SQL})")
def _(d: Data):
    rows = N.normalize_entity(raw_items(d), keep=["seq"])
    return rows.select(
        "seq", "content_id", "title", "addr1", F.col("map_x").cast("double").alias("map_x"),
        F.col("map_y").cast("double").alias("map_y"), F.col("map_level").cast("int").alias("map_level"), "category",
        "first_image", F.date_format("created_time", "yyyy-MM-dd HH:mm:ss").alias("created_time"), "content_hash",
    )


@query("quarantine_split", f"""
SELECT seq, CASE WHEN content_id IS NULL THEN 'missing_id' WHEN title IS NULL THEN 'missing_title'
  WHEN category IS NULL THEN 'unsupported_category' ELSE 'valid' END AS verdict FROM ({NORMAL_SQL})""")
def _(d: Data):
    good, bad = N.quarantine_split(N.normalize_entity(raw_items(d), keep=["seq"]), N.entity_rules())
    return union_rows(good.select("seq", F.lit("valid").alias("verdict")), bad.select("seq", F.col("_reason").alias("verdict")))


@query("normalize_codes", """
SELECT DISTINCT code, name, 2 AS depth, p_type AS parent_code FROM (
  SELECT trim(p_brand) AS code, nullif(CASE WHEN p_size > 45 THEN '' ELSE p_type || '/' || p_brand END, '') AS name, p_type FROM part)
WHERE name IS NOT NULL""")
def _(d: Data):
    raw = d.part.select(
        F.concat(F.lit(" "), "p_brand").alias("code"),
        F.when(F.col("p_size") > 45, " ").otherwise(F.concat_ws("/", "p_type", "p_brand")).alias("name"),
        "p_type",
    )
    return N.normalize_codes(raw, {"depth": F.lit(2), "parent_code": F.col("p_type")}).distinct()


@query("normalize_detail", """
SELECT doc_id AS content_id, source AS homepage, nullif(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '') AS overview,
  nullif(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '')[1:200] AS infocenter, CASE WHEN lang <> 'de' THEN lang END AS parking
FROM documents WHERE n_chars >= 50""")
def _(d: Data):
    raw = d.documents.select(
        F.when(F.col("n_chars") >= 50, F.col("doc_id").cast("string")).otherwise("n/a").alias("contentid"),
        F.concat(F.lit("　"), "source").alias("homepage"),
        F.col("text").alias("overview"),
        F.col("text").alias("infocenter"),
        F.when(F.col("lang") == "de", " ").otherwise(F.col("lang")).alias("parking"),
    )
    common = N.normalize_detail_common(raw)
    intro = N.normalize_detail_intro(raw)
    return common.join(intro, "content_id").select("content_id", "homepage", "overview", "infocenter", "parking")


# Lines as images of their order; the long key makes the response order total.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


@query("normalize_images", f"""
SELECT l_orderkey AS content_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS INTEGER) AS "order", image_url
FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'http://o/' || l_partkey WHEN l_linestatus = 'O' THEN 'http://s/' || l_suppkey END AS image_url FROM lineitem)
WHERE image_url IS NOT NULL""")
def _(d: Data):
    raw = d.lineitem.select(
        "l_orderkey", *LINE_ORDER,
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("http://o/"), "l_partkey")).otherwise("  ").alias("originimgurl"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("http://s/"), "l_suppkey")).alias("smallimageurl"),
    )
    return N.normalize_images(raw, [F.col(c).asc() for c in LINE_ORDER], parent="l_orderkey")


@query("ordinal_assign", f"""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {LINE_ORDER_SQL}) AS ordinal FROM lineitem""")
def _(d: Data):
    rows = d.lineitem.select("l_suppkey", "l_orderkey", *[c for c in LINE_ORDER if c != "l_suppkey"])
    order = [F.col("l_orderkey").asc()] + [F.col(c).asc() for c in LINE_ORDER if c != "l_suppkey"]
    return N.ordinal_assign(rows, "l_suppkey", order, "ordinal").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "ordinal"
    )


@query("detail_info_pack", f"""
SELECT l_orderkey, CAST(to_json(list({{'part': l_partkey, 'flag': l_returnflag}} ORDER BY {LINE_ORDER_SQL})) AS VARCHAR) AS detail_info
FROM lineitem GROUP BY l_orderkey""")
def _(d: Data):
    items = d.lineitem.withColumns({"part": F.col("l_partkey"), "flag": F.col("l_returnflag")})
    return N.detail_info_pack(items, "l_orderkey", LINE_ORDER, ["part", "flag"])


# --- snapshots -----------------------------------------------------------------


@query("snapshot_csv_read", """
SELECT doc_id, nullif(text, '') AS text, lang FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents)""")
def _(d: Data):
    path = S.write_snapshot([d.documents.select("doc_id", "text", "lang")], scratch_path(d.spark, "snapshot"), DAY)
    return S.read_snapshot(d.spark, path).select("doc_id", F.nullif("text", F.lit("")).alias("text"), "lang")


@query("snapshot_csv_write", f"""
SELECT contentid, title, nullif(firstimage, '') AS firstimage, CAST(NULL AS VARCHAR) AS phone FROM ({RAW_SQL})
UNION ALL SELECT s_suppkey || '', s_name, NULL, s_nationkey || '-' || s_suppkey FROM supplier""")
def _(d: Data):
    base = scratch_path(d.spark, "snapshot")
    items = raw_items(d).select("contentid", "title", "firstimage")
    others = d.supplier.select(
        F.col("s_suppkey").alias("contentid"), F.col("s_name").alias("title"), F.concat_ws("-", "s_nationkey", "s_suppkey").alias("phone")
    )
    path = S.write_snapshot([items, others], base, DAY)
    again = S.write_snapshot([others], base, DAY)  # the day has its snapshot: nothing is written
    assert path == again
    return S.read_snapshot(d.spark, again).select("contentid", "title", "firstimage", "phone")


# --- nested trend snapshots ------------------------------------------------------

DOC_SQL = """SELECT event_id, event_type AS city_name, CASE WHEN value < 20 THEN 'blog' ELSE 'cafe' END AS channel,
  CASE WHEN value < 1 THEN '' ELSE 'u' || event_id END AS url, props AS title FROM events"""


def trend_docs(d: Data):
    return d.events.select(
        "event_id",
        F.col("event_type").alias("city_name"),
        F.when(F.col("value") < 20, "blog").otherwise("cafe").alias("channel"),
        F.when(F.col("value") < 1, "").otherwise(F.concat(F.lit("u"), "event_id")).alias("url"),
        F.col("props").alias("title"),
    )


@query("trend_snapshot_nest", f"""
SELECT city_name, channel, chunk_no, CAST(json_object(city_name, json_object(channel, docs)) AS VARCHAR) AS json
FROM (SELECT city_name, channel, chunk_no, list({{'url': url, 'title': title}} ORDER BY event_id) AS docs FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY city_name, channel ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk_no FROM ({DOC_SQL}))
GROUP BY city_name, channel, chunk_no)""")
def _(d: Data):
    return J.nest_by(trend_docs(d), "city_name", "channel", [F.col("event_id").asc()], ["url", "title"])


@query("trend_snapshot_flatten", f"SELECT city_name, channel, url, title FROM ({DOC_SQL}) WHERE url <> ''")
def _(d: Data):
    nested = J.nest_by(trend_docs(d), "city_name", "channel", [F.col("event_id").asc()], ["url", "title"])
    path = J.write_nested(nested, J.snapshot_file(scratch_path(d.spark, "trend"), "raw", DAY, "run-0001-abc"))
    return J.flatten_trend(J.read_nested(d.spark, path)).select("city_name", "channel", "url", "title")


# --- pages -----------------------------------------------------------------------

PER_PAGE = 20
# Result code of a request; the last page of a listing may hold a single object.
CODE = "CASE n.n_nationkey WHEN 3 THEN '22' WHEN 7 THEN ' 03 ' WHEN 11 THEN '' WHEN 13 THEN '00' WHEN 17 THEN '99' ELSE '0000' END"


def landed_pages(d: Data, code: str = CODE):
    """Customers of each nation as pages of a listing, with a blank page after the last."""
    numbered = distributed_row_number(
        d.customer.select("c_nationkey", "c_custkey", "c_name"), ["c_nationkey"], [F.col("c_custkey").asc()], "rn"
    )
    item = F.struct(F.col("c_custkey").alias("contentid"), F.col("c_name").alias("title"))
    filled = (
        numbered.withColumn("page_no", F.floor((F.col("rn") - 1) / PER_PAGE) + 1)
        .groupBy("c_nationkey", "page_no")
        .agg(F.array_sort(F.collect_list(item)).alias("_list"))
        .withColumn("item", F.when(F.size("_list") == 1, F.to_json(F.col("_list")[0])).otherwise(F.to_json("_list")))
        .select("c_nationkey", "page_no", F.concat(F.lit('{"item":'), "item", F.lit("}")).alias("items"))
    )
    totals = d.customer.groupBy("c_nationkey").agg(F.count("*").alias("total"))
    blank = totals.select(
        "c_nationkey", (F.ceil(F.col("total") / PER_PAGE) + 1).alias("page_no"), F.lit('""').alias("items")
    )
    code = F.expr(code.replace("n.n_nationkey", "c_nationkey"))
    body = F.concat(
        F.lit('{"response":{"header":{"resultCode":"'), code, F.lit('","resultMsg":"-"},"body":{"items":'),
        F.col("items"), F.lit(',"totalCount":'), F.col("total"), F.lit("}}}"),
    )
    return union_rows(filled, blank).join(totals, "c_nationkey").select(
        F.col("c_nationkey").alias("request"), F.col("page_no").cast("int").alias("page_no"),
        F.lit(PER_PAGE).alias("num_rows"), body.alias("body"),
    )


PAGES_SQL = f"""SELECT request, page_no, status, result_code, CASE WHEN status = 'ok' THEN total ELSE 0 END AS total_count,
  CASE WHEN status = 'ok' THEN greatest(0, least({PER_PAGE}, total - (page_no - 1) * {PER_PAGE})) ELSE 0 END AS n_items
FROM (SELECT *, CASE WHEN result_code IN ('0000', '00') THEN 'ok' WHEN result_code = '03' THEN 'nodata' WHEN result_code = '22' THEN 'quota' ELSE 'error' END AS status
  FROM (SELECT n.n_nationkey AS request, total, CAST(unnest(range(1, CAST(ceil(total / {PER_PAGE}) AS BIGINT) + 2)) AS INTEGER) AS page_no,
      coalesce(nullif(trim({CODE}), ''), 'UNKNOWN') AS result_code
    FROM nation n JOIN (SELECT c_nationkey, count(*) AS total FROM customer GROUP BY 1) ON c_nationkey = n_nationkey))"""


@query("page_response_parse", PAGES_SQL)
def _(d: Data):
    parsed = P.parse_pages(landed_pages(d))
    return parsed.select("request", "page_no", "status", "result_code", "total_count", F.size("items").cast("bigint").alias("n_items"))


@query("page_assemble", f"""
WITH p AS ({PAGES_SQL}), e AS (SELECT request, min(page_no) AS last FROM p WHERE page_no * {PER_PAGE} >= total_count OR n_items = 0 GROUP BY 1),
kept AS (SELECT p.* FROM p JOIN e USING (request) WHERE page_no <= last)
SELECT request, page_no, contentid, title FROM (
  SELECT c_nationkey AS request, CAST(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / {PER_PAGE}) + 1 AS INTEGER) AS page_no,
    CAST(c_custkey AS VARCHAR) AS contentid, c_name AS title FROM customer)
SEMI JOIN (SELECT * FROM kept WHERE n_items > 0) USING (request, page_no)""")
def _(d: Data):
    kept = P.assemble_pages(P.parse_pages(landed_pages(d)), ["request"])
    items = P.page_items(kept, ["request"])
    return items.select("request", "page_no", F.col("item")["contentid"].alias("contentid"), F.col("item")["title"].alias("title"))


@query("single_lookup", """
SELECT c_nationkey AS request, CAST(min(c_custkey) AS VARCHAR) AS contentid FROM customer
WHERE c_nationkey NOT IN (3, 7, 11, 17) GROUP BY 1""")
def _(d: Data):
    first = P.first_item(P.parse_pages(landed_pages(d)), ["request"])
    return first.select("request", F.col("item")["contentid"].alias("contentid"))


@query("land_listing", f"""
SELECT CAST(c_custkey AS VARCHAR) AS contentid, c_name AS title,
  printf('%d|%010d|%06d', c_nationkey, CAST(floor((rn - 1) / {PER_PAGE}) + 1 AS BIGINT), CAST((rn - 1) % {PER_PAGE} AS BIGINT)) AS seq
FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)""")
def _(d: Data):
    path = land_listing(landed_pages(d, "'0000'"), scratch_path(d.spark, "landing"), DAY)
    return S.read_snapshot(d.spark, path).select("contentid", "title", "seq")


# --- tables and outbox -------------------------------------------------------------


@query("code_table_scan", """
SELECT DISTINCT p_brand AS code, p_type AS parent_code FROM part WHERE p_type = 'ECONOMY' ORDER BY 1""")
def _(d: Data):
    codes = d.part.select(F.col("p_brand").alias("code"), F.col("p_type").alias("parent_code")).distinct()
    return code_table_scan(codes, ["code", "parent_code"], ["code"], F.col("parent_code") == "ECONOMY")


@query("table_scan_sink", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer""")
def _(d: Data):
    tables = Tables(d.spark, scratch_path(d.spark, "tables"))
    rows = d.customer.select("c_custkey", "c_name", "c_acctbal")
    stored = tables.write("account", rows, token="load-1")
    fixed = stored.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal")))
    tables.write("account", fixed, token="fix-1")
    tables.write("account", rows, token="fix-1")  # same token: nothing is written
    return tables.read("account")


READY_SQL = """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 100000"""


def order_flags(d: Data):
    return d.orders.select(
        F.col("o_orderkey").alias("content_id"),
        (F.col("o_orderstatus") != "F").alias("embed_pending"),
        (F.col("o_orderpriority") == "1-URGENT").alias("detail_common_pending"),
        (F.col("o_orderpriority") == "2-HIGH").alias("detail_intro_pending"),
        (F.col("o_totalprice") < 100000).alias("detail_info_pending"),
        (F.col("o_totalprice") > 400000).alias("image_pending"),
    )


@query("outbox_batches", f"""
SELECT batch_no, count(*) AS n_ids, CAST(json_object('runId', 'run-1', 'contentIds', list(o_orderkey ORDER BY o_orderkey)) AS VARCHAR) AS message
FROM (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500) AS BIGINT) AS batch_no FROM ({READY_SQL}))
GROUP BY batch_no""")
def _(d: Data):
    return outbox_batches(ready_filter(order_flags(d)), "run-1", limit=None, batch_size=500)


@query("outbox_accepted", f"SELECT count(*) AS accepted FROM ({READY_SQL})")
def _(d: Data):
    batches = outbox_batches(ready_filter(order_flags(d)), "run-1", limit=None, batch_size=500)
    return write_outbox(batches, scratch_path(d.spark, "outbox"))
