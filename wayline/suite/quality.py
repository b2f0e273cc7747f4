"""Constraints as checks, stage counters and the run ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.operators import quality as Q
from wayline.suite.base import Data, query


@query("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(d: Data):
    return Q.check_unique(d.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_domain", """
SELECT 'quantity_1_to_40' AS rule, count(*) FILTER (l_quantity NOT BETWEEN 1 AND 40) AS violations FROM lineitem
UNION ALL SELECT 'flag_in_set', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'ship_set', count(*) FILTER (l_shipdate IS NULL) FROM lineitem""")
def _(d: Data):
    rules = {
        "quantity_1_to_40": F.col("l_quantity").between(1, 40),
        "flag_in_set": F.col("l_returnflag").isin("A", "N"),
        "ship_set": F.col("l_shipdate").isNotNull(),
    }
    return Q.check_domain(d.lineitem, rules)


@query("check_exclusive", """
SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F') = (o_totalprice > 250000)""")
def _(d: Data):
    rows = d.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("first_id"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_custkey")).alias("second_id"),
    )
    return Q.check_exclusive(rows, ["first_id", "second_id"]).select("o_orderkey")


@query("check_orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def _(d: Data):
    children = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.check_orphans(children, d.orders.where("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")


@query("stage_stats", """
SELECT o_orderpriority, count(*) AS processed, count(*) FILTER (o_totalprice > 200000) AS changed, count(*) FILTER (o_totalprice < 5000) AS quarantined,
  count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders GROUP BY 1""")
def _(d: Data):
    counters = {
        "processed": F.lit(True),
        "changed": F.col("o_totalprice") > 200000,
        "quarantined": F.col("o_totalprice") < 5000,
        "failed": F.col("o_orderstatus") == "F",
        "pending": F.col("o_orderstatus") == "P",
    }
    return Q.stage_stats(d.orders, counters, ["o_orderpriority"])


# Runs are orders, their stages the order's lines by return flag. Orders before
# 1999 have run before; those from 1998 on start now; cheap ones never finish.
@query("run_ledger", """
WITH st AS (SELECT l_orderkey, l_returnflag AS stage, count(*) AS processed, max(l_discount) > 0.09 AS bad FROM lineitem GROUP BY ALL),
res AS (SELECT l_orderkey, CASE WHEN max(bad) THEN 'failed' ELSE 'success' END AS status, '{' || string_agg('"' || stage || '":' || processed, ',' ORDER BY stage) || '}' AS stats FROM st GROUP BY 1)
SELECT o_orderpriority AS dag_id, CAST(o_orderkey AS VARCHAR) AS run_id,
  CASE WHEN done THEN res.status WHEN starts THEN 'running' ELSE 'success' END AS status,
  CASE WHEN starts THEN '2024-06-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS started_at,
  CASE WHEN done THEN '2024-06-01 01:00:00' WHEN NOT starts THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS finished_at,
  CASE WHEN done THEN res.stats WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '{}' END AS stats
FROM (SELECT o.*, o_orderdate >= TIMESTAMP '1998-01-01' AS starts, o_totalprice >= 100000 AND r.l_orderkey IS NOT NULL AS done FROM orders o LEFT JOIN res r ON l_orderkey = o_orderkey) LEFT JOIN res ON l_orderkey = o_orderkey""")
def _(d: Data):
    run = [F.col("o_orderpriority").alias("dag_id"), F.col("o_orderkey").cast("string").alias("run_id")]
    ledger = d.orders.where("o_orderdate < '1999-01-01'").select(
        *run, F.lit("success").alias("status"), F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("finished_at"),
        F.lit("{}").alias("stats"),
    )
    now = lambda t: F.lit(t).cast("timestamp_ntz")
    started = Q.start_runs(ledger, d.orders.where("o_orderdate >= '1998-01-01'").select(*run), now("2024-06-01 00:00:00"))
    ended = d.orders.where("o_totalprice >= 100000").select("o_orderkey", *run)
    stages = (
        d.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("stage"))
        .agg(F.count("*").alias("processed"), F.max("l_discount").alias("worst"))
        .join(ended, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("status", F.when(F.col("worst") > 0.09, "failed").otherwise("success"))
    )
    final = Q.finish_runs(started, Q.run_results(stages), now("2024-06-01 01:00:00"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return final.select("dag_id", "run_id", "status", text("started_at"), text("finished_at"), "stats")
