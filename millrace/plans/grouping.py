"""Registered aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import grouping, joins
from millrace.plans.registry import query
from millrace.plans.scans import BENCH_CTE
from millrace.session import write_through
from millrace.sources import synth
from millrace.tables import load


@query("agg_global", """
    SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS lo, max(value) AS hi FROM events
""")
def agg_global(spark, sf):
    return load(spark, sf, "events", "ts", "value").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
    )


@query("agg_group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_group_count(spark, sf):
    return load(spark, sf, "events", "event_type").groupBy("event_type").agg(F.count("*").alias("n"))


@query("agg_count_avg_sum", BENCH_CTE + """
    , both_sets AS (
      SELECT log_level AS key, response_time AS v FROM logs
      UNION ALL SELECT l_returnflag, l_extendedprice FROM lineitem)
    SELECT key, count(*) AS n, round(avg(v), 4) AS avg_v, round(sum(v), 2) AS sum_v FROM both_sets GROUP BY key
""")
def agg_count_avg_sum(spark, sf):
    logs = synth.benchmark_logs(load(spark, sf, "orders", "o_orderkey"), "o_orderkey")
    items = load(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    rows = logs.select(F.col("log_level").alias("key"), F.col("response_time").alias("v")).union(items)
    return rows.groupBy("key").agg(
        F.count("*").alias("n"), F.round(F.avg("v"), 4).alias("avg_v"), F.round(F.sum("v"), 2).alias("sum_v")
    )


@query("agg_max_string", """
    SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS top_priority FROM orders GROUP BY o_custkey
""")
def agg_max_string(spark, sf):
    return load(spark, sf, "orders", "o_custkey", "o_orderpriority").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.max("o_orderpriority").alias("top_priority")
    )


@query("agg_count_distinct", """
    SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
""")
def agg_count_distinct(spark, sf):
    return load(spark, sf, "events", "event_type", "user_id").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("n_users")
    )


@query("agg_two_keys", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL
""")
def agg_two_keys(spark, sf):
    orders = load(spark, sf, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    return orders.filter("o_orderdate >= TIMESTAMP_NTZ'1998-01-01'").groupBy(
        "o_orderstatus", "o_orderpriority"
    ).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("value_counts", """
    SELECT 'event_type' AS "column", event_type AS value, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY 2
""")
def value_counts(spark, sf):
    events = load(spark, sf, "events", "event_type", "user_id", "props")
    return grouping.value_counts(events, ["event_type", "user_id", "props"])


@query("agg_order_by_sum", """
    SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
    GROUP BY c_mktsegment ORDER BY balance DESC, c_mktsegment
""")
def agg_order_by_sum(spark, sf):
    return load(spark, sf, "customer", "c_mktsegment", "c_acctbal").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    ).orderBy(F.desc("balance"), "c_mktsegment")


DIMS = ["c_mktsegment", "o_orderpriority", "o_orderstatus"]


def _cube(spark, sf):
    orders = load(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    customer = load(spark, sf, "customer", "c_custkey", "c_mktsegment")
    facts = joins.join(orders, customer, F.expr("o_custkey = c_custkey"))
    return grouping.build_cube(facts, DIMS, ["o_totalprice"])


@query("startree_cube", """
    SELECT c_mktsegment, o_orderpriority, o_orderstatus,
           GROUPING(c_mktsegment, o_orderpriority, o_orderstatus) AS level,
           round(sum(o_totalprice), 2) AS sum_o_totalprice, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY CUBE (c_mktsegment, o_orderpriority, o_orderstatus)
""")
def startree_cube(spark, sf):
    return _cube(spark, sf).withColumn("sum_o_totalprice", F.round("sum_o_totalprice", 2))


@query("startree_lookup", """
    SELECT c_mktsegment, round(sum(o_totalprice), 2) AS sum_o_totalprice, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' GROUP BY c_mktsegment
""")
def startree_lookup(spark, sf):
    cube = write_through(_cube(spark, sf), "cube")
    return grouping.query_cube(cube, DIMS, ["c_mktsegment"], {"o_orderstatus": "F"}).withColumn(
        "sum_o_totalprice", F.round("sum_o_totalprice", 2)
    )


@query("merge_rollup_daily", """
    SELECT date_trunc('day', ts) AS ts, event_type, count(*) AS n, round(sum(value), 2) AS value
    FROM events GROUP BY ALL
""")
def merge_rollup_daily(spark, sf):
    hourly = load(spark, sf, "events", "ts", "event_type", "value").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type"
    ).agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    daily = grouping.roll_up(hourly, "ts", "day", ["event_type"], ["n", "value"])
    return daily.withColumn("value", F.round("value", 2))


@query("skew_report", """
    SELECT l_suppkey, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
    FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10
""")
def skew_report(spark, sf):
    return grouping.top_keys(load(spark, sf, "lineitem", "l_suppkey"), "l_suppkey", 10)
