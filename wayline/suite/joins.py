"""Change detection, keyed merges, queues and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import changes as C, merge as M, queues as Q
from wayline.operators.quality import bootstrap_needed, category_tree, parent_code
from wayline.operators.resolve import dim_lookup_skip
from wayline.session import union_rows
from wayline.suite.base import Data, query
from wayline.suite.sources import READY_SQL, order_flags

NOW = "2024-06-01 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# --- duplicates and changes -------------------------------------------------------


@query("dedup_last_wins", """
SELECT max(doc_id) AS doc_id, text FROM documents GROUP BY text""")
def _(d: Data):
    return C.dedup_last_wins(d.documents.select("doc_id", "text"), ["text"], ["doc_id"])


@query("priority_dedup", """
SELECT lang, doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src7' THEN 1 ELSE 2 END,
  n_chars DESC, doc_id DESC) AS rn FROM documents) WHERE rn = 1""")
def _(d: Data):
    rank = C.source_priority(F.col("source"), ["src3", "src7"])
    docs = d.documents.select("lang", "doc_id", "source", "n_chars")
    return C.priority_dedup(docs, "lang", rank, [F.col("n_chars").desc(), F.col("doc_id").desc()]).drop("n_chars")


# Yesterday's state: customers in debt are not known yet, the hash of furniture
# customers was another one; the business row of the last nation was lost.
STATE_SQL = """SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN sha256('old' || c_name) ELSE sha256(c_name) END AS h FROM customer WHERE c_acctbal >= 0"""


@query("detect_changes", f"""
SELECT c_custkey FROM (SELECT c_custkey, sha256(c_name) AS h FROM customer) s
LEFT JOIN (SELECT c_custkey, h AS old FROM ({STATE_SQL}) JOIN (SELECT c_custkey FROM customer WHERE c_nationkey <> 24) USING (c_custkey)) USING (c_custkey)
WHERE old IS NULL OR old <> h""")
def _(d: Data):
    source = d.customer.select("c_custkey", F.sha2("c_name", 256).alias("h"))
    old = F.when(F.col("c_mktsegment") == "FURNITURE", F.sha2(F.concat(F.lit("old"), "c_name"), 256)).otherwise(F.sha2("c_name", 256))
    state = d.customer.where("c_acctbal >= 0").select("c_custkey", old.alias("h"))
    stored = d.customer.where("c_nationkey <> 24").select("c_custkey")
    return C.detect_changes(source, state, stored, "c_custkey", "h").select("c_custkey")


@query("change_reasons", """
SELECT o_orderkey, concat_ws(',', CASE WHEN NOT known THEN 'new' END, CASE WHEN known AND o_orderdate > TIMESTAMP '2000-01-01' THEN 'updated' END,
  CASE WHEN known AND o_orderstatus = 'P' THEN 'content' END, CASE WHEN known AND o_orderpriority = '5-LOW' THEN 'rule_version' END) AS reasons
FROM (SELECT *, o_totalprice >= 50000 AS known FROM orders)
WHERE NOT known OR o_orderdate > TIMESTAMP '2000-01-01' OR o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""")
def _(d: Data):
    source = d.orders.select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("h"), F.lit("r2").alias("rule_version"))
    state = d.orders.where("o_totalprice >= 50000").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus")).alias("h"),
        F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'").alias("collected_at"),
        F.when(F.col("o_orderpriority") == "5-LOW", "r1").otherwise("r2").alias("rule_version"),
    )
    changed = C.change_reasons(source, state, "o_orderkey", "h", "o_orderdate", "collected_at", ["rule_version"])
    return changed.select("o_orderkey", F.array_join("reasons", ",").alias("reasons"))


# --- keyed merges -------------------------------------------------------------------


@query("merge_upsert", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
  CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN o_orderpriority END AS kept,
  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'new' WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'updated' ELSE 'stored' END AS mark FROM orders""")
def _(d: Data):
    target = d.orders.where("o_orderdate < '2000-01-01'").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("kept"), F.lit("stored").alias("mark")
    )
    source = d.orders.where("o_orderdate >= '1999-01-01'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("price"))
    return M.merge_upsert(
        target, source, ["o_orderkey"], insert_defaults={"mark": F.lit("new")}, set_on_match={"mark": F.lit("updated")}
    )


@query("state_upsert", f"""
SELECT o_orderkey AS content_id, CASE WHEN changed THEN 'new' ELSE 'old' END || o_orderkey AS content_hash,
  CASE WHEN changed THEN true ELSE o_orderpriority = '1-URGENT' END AS detail_common_pending,
  CASE WHEN changed THEN true ELSE o_orderpriority = '2-HIGH' END AS detail_intro_pending,
  CASE WHEN changed THEN true ELSE o_totalprice < 100000 END AS detail_info_pending,
  CASE WHEN changed THEN o_totalprice > 250000 ELSE o_totalprice > 400000 END AS image_pending,
  CASE WHEN changed THEN true ELSE o_orderstatus <> 'F' END AS embed_pending,
  CASE WHEN changed THEN o_totalprice <= 250000 ELSE false END AS image_absent,
  CASE WHEN changed AND stored THEN '{NOW}' END AS last_etl_at
FROM (SELECT *, o_orderdate < TIMESTAMP '2000-01-01' AS stored, o_orderdate >= TIMESTAMP '1999-01-01' AS changed FROM orders)""")
def _(d: Data):
    stored_keys = d.orders.where("o_orderdate < '2000-01-01'").select(F.col("o_orderkey").alias("content_id"))
    state = order_flags(d).join(stored_keys, "content_id", "left_semi").select(
        "content_id", F.concat(F.lit("old"), "content_id").alias("content_hash"), "detail_common_pending", "detail_intro_pending",
        "detail_info_pending", "image_pending", "embed_pending", F.lit(False).alias("image_absent"),
        F.lit(None).cast("timestamp_ntz").alias("last_etl_at"),
    )
    changed = d.orders.where("o_orderdate >= '1999-01-01'").select(
        F.col("o_orderkey").alias("content_id"),
        F.concat(F.lit("new"), "o_orderkey").alias("content_hash"),
        F.when(F.col("o_totalprice") > 250000, "http://img").alias("first_image"),
    )
    merged = M.state_upsert(state, changed, _now())
    return merged.withColumn("last_etl_at", F.date_format("last_etl_at", "yyyy-MM-dd HH:mm:ss"))


@query("update_from", """
SELECT c_custkey, CASE WHEN n.last_date IS NULL THEN c_mktsegment WHEN n.total > 1000000 THEN NULL ELSE 'seen ' || n.n END AS note
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_date, sum(o_totalprice) AS total, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) n
ON c_custkey = o_custkey""")
def _(d: Data):
    target = d.customer.select("c_custkey", F.col("c_mktsegment").alias("note"))
    done = d.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("total"), F.count("*").alias("n")
    )
    # A matched NULL overwrites the stored note.
    source = done.select("c_custkey", F.when(~(F.col("total") > 1000000), F.concat(F.lit("seen "), "n")).alias("note"))
    return M.update_from(target, source, ["c_custkey"], ["note"])


REPLACED = "o_orderpriority = '1-URGENT'"


@query("replace_children", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {REPLACED})
UNION ALL SELECT o_orderkey, 1, o_custkey, o_totalprice FROM orders WHERE {REPLACED} AND o_orderstatus <> 'F'""")
def _(d: Data):
    children = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    parents = d.orders.where(REPLACED).select(F.col("o_orderkey").alias("l_orderkey"))
    new = d.orders.where(f"{REPLACED} AND o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("o_custkey").alias("l_partkey"),
        F.col("o_totalprice").alias("l_quantity"),
    )
    return M.replace_children(children, parents, new, "l_orderkey")


@query("fill_if_null", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, url) AS first_image FROM orders
LEFT JOIN (SELECT l_orderkey, 'p' || min(l_partkey) AS url FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(d: Data):
    target = d.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("first_image"))
    first = d.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("p"))
    urls = first.select("o_orderkey", F.concat(F.lit("p"), "p").alias("url"))
    return M.fill_if_null(target, urls, "o_orderkey", "first_image", "url")


@query("clear_flags", """
SELECT o_orderkey, o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' AS image_pending,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice < 100000 ELSE false END AS image_absent FROM orders""")
def _(d: Data):
    state = d.orders.select("o_orderkey", (F.col("o_orderstatus") != "F").alias("image_pending"), F.lit(False).alias("image_absent"))
    done = d.orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", (F.col("o_totalprice") < 100000).alias("absent"))
    cleared = M.clear_flags(state, done, "o_orderkey", "image_pending")
    return M.clear_flags(cleared, done, "o_orderkey", "image_absent", F.col("s.absent"))


@query("cascade_delete", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag <> 'N' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')""")
def _(d: Data):
    children = d.lineitem.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber", "l_partkey"
    )
    return M.cascade_delete(children, d.orders.where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey")


@query("set_null_on_delete", """
SELECT CASE WHEN o_orderkey IS NOT NULL THEN l_orderkey END AS l_orderkey, l_linenumber, l_partkey FROM lineitem
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') ON l_orderkey = o_orderkey""")
def _(d: Data):
    children = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return M.set_null_on_delete(children, d.orders.where("o_orderstatus <> 'F'"), "l_orderkey", "o_orderkey")


@query("deactivate_missing", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND c_mktsegment <> 'BUILDING' AS active FROM customer""")
def _(d: Data):
    target = d.customer.select("c_custkey", (F.col("c_mktsegment") != "BUILDING").alias("active"))
    source = d.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return M.deactivate_missing(target, source, "c_custkey")


# --- queues ----------------------------------------------------------------------------


@query("pending_queue", "SELECT o_orderkey AS content_id FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY 1 LIMIT 300")
def _(d: Data):
    return Q.pending_queue(order_flags(d), "detail_common_pending")


@query("ready_queue", f"SELECT o_orderkey AS content_id FROM ({READY_SQL}) ORDER BY 1 LIMIT 10")
def _(d: Data):
    return Q.ready_queue(order_flags(d))


@query("ready_filter", f"SELECT o_orderkey AS content_id FROM ({READY_SQL})")
def _(d: Data):
    return Q.ready_filter(order_flags(d)).select("content_id")


@query("ordered_limit", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_partkey LIMIT 100")
def _(d: Data):
    rows = d.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    return Q.ordered_limit(rows, [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_partkey").asc()], 100)


@query("missing_children", """
SELECT c_custkey AS content_id FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
ORDER BY 1 LIMIT 500""")
def _(d: Data):
    parents = d.customer.select(F.col("c_custkey").alias("content_id"))
    state = d.customer.select(F.col("c_custkey").alias("content_id"), (F.col("c_acctbal") < 0).alias("image_absent"))
    children = d.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("content_id"))
    return Q.missing_children(parents, state, children)


STATUS = """CASE WHEN o_totalprice > 499900 THEN 'quota' WHEN o_orderstatus = 'P' THEN 'error' WHEN o_orderstatus = 'F' THEN 'nodata' ELSE 'ok' END"""


@query("stop_at_first_failure", f"""
WITH r AS (SELECT o_orderkey, o_orderpriority AS kind, {STATUS} AS status FROM orders)
SELECT kind, o_orderkey, CASE WHEN status IN ('ok', 'nodata') THEN 'done' ELSE 'failed' END AS outcome
FROM (SELECT *, min(CASE WHEN status = 'quota' THEN o_orderkey END) OVER (PARTITION BY kind) AS stop FROM r) WHERE stop IS NULL OR o_orderkey < stop""")
def _(d: Data):
    responses = d.orders.select("o_orderkey", F.col("o_orderpriority").alias("kind"), F.expr(STATUS).alias("status"))
    return Q.stop_at_first_failure(responses, ["kind"], "o_orderkey").select("kind", "o_orderkey", "outcome")


# --- lookups and code trees ---------------------------------------------------------------


@query("dim_lookup_skip", """
SELECT c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS known, count(*) AS customers FROM customer GROUP BY 1""")
def _(d: Data):
    dim = d.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    known, skipped = dim_lookup_skip(d.customer.select("c_custkey", "c_nationkey"), dim, "c_nationkey")
    both = union_rows(known.withColumn("known", F.lit(True)), skipped.withColumn("known", F.lit(False)))
    return both.groupBy("known").agg(F.count("*").alias("customers"))


@query("category_tree", """
WITH a AS (SELECT DISTINCT p_type FROM part), b AS (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size > 5),
c AS (SELECT DISTINCT p_type, p_brand, p_size FROM part)
SELECT p_type AS code, 1 AS depth, p_type AS root, p_type AS path FROM a
UNION ALL SELECT p_type || p_brand, 2, p_type, p_type || ' > ' || p_brand FROM b
UNION ALL SELECT p_type || p_brand || '/' || p_size, 3, p_type, p_type || ' > ' || p_brand || ' > ' || p_size FROM c SEMI JOIN b USING (p_type, p_brand)""")
def _(d: Data):
    level1, level2 = F.col("p_type"), F.concat("p_type", "p_brand")
    none = F.lit(None).cast("string")
    row = lambda rows, code, name, depth, parent: rows.select(
        code.alias("code"), name.alias("name"), F.lit(depth).alias("depth"), parent.alias("parent_code")
    )
    level3 = F.concat(level2, F.lit("/"), "p_size")
    codes = union_rows(
        row(d.part, level1, level1, 1, parent_code(none, none)),
        row(d.part.where("p_size > 5"), level2, F.col("p_brand"), 2, parent_code(level1, none)),
        row(d.part, level3, F.col("p_size").cast("string"), 3, parent_code(level1, level2)),
    ).distinct()
    return category_tree(codes)


@query("bootstrap_needed", """
SELECT DISTINCT c_nationkey, c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS needed FROM customer""")
def _(d: Data):
    codes = d.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))
    return bootstrap_needed(d.customer, codes, "c_nationkey")
