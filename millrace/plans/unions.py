"""Registered unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import arranging
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import sinks
from millrace.tables import load


@query("hybrid_union", "SELECT event_id, ts, event_type FROM events")
def hybrid_union(spark, sf):
    events = load(spark, sf, "events", "event_id", "ts", "event_type")
    offline = events.filter("ts < TIMESTAMP_NTZ'2024-01-20'")
    realtime = events.filter("ts >= TIMESTAMP_NTZ'2024-01-15'")
    return arranging.hybrid(offline, realtime, "ts")


@query("metadata_driven_feeds", """
    SELECT region, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
      SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'us' WHEN o_orderpriority = '2-HIGH' THEN 'eu' ELSE 'apac' END
             AS region, o_totalprice FROM orders) GROUP BY region
""")
def metadata_driven_feeds(spark, sf):
    rules = {
        "us": "o_orderpriority = '1-URGENT'", "eu": "o_orderpriority = '2-HIGH'",
        "apac": "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
    }
    orders = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderpriority")
    root = scratch_path(spark, "feeds")
    feeds = {}
    for region, rule in rules.items():
        sinks.parquet(orders.filter(rule), f"{root}/{region}")
        feeds[region] = spark.read.parquet(f"{root}/{region}")
    return arranging.tagged_feeds(feeds, "region").groupBy("region").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
