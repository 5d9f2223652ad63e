"""Registered data quality steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import quality
from millrace.plans.registry import query
from millrace.plans.schemas import REQUIRED, damaged
from millrace.session import scratch_path
from millrace.sources import files, sinks, topics
from millrace.tables import load


def _damaged_topic(spark, sf):
    rows = damaged(load(spark, sf, "events"))
    return topics.as_topic(
        rows, "events", F.col("user_id"), F.col("value"), F.col("event_id"), F.col("ts"), 4
    )


@query("dead_letter_split", """
    SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
           CASE event_id % 10 WHEN 0 THEN 'missing:user_id' WHEN 1 THEN 'type:user_id'
           WHEN 2 THEN 'not_json' WHEN 3 THEN 'not_json' ELSE 'good' END AS reason FROM events
""")
def dead_letter_split(spark, sf):
    good, bad = quality.split_bad(_damaged_topic(spark, sf), "value", REQUIRED)
    return good.select("partition", "offset", F.lit("good").alias("reason")).union(
        bad.select("partition", "offset", "reason")
    )


@query("reconcile_counts", """
    WITH s AS (SELECT year(o_orderdate) AS year, count(*) AS n_src FROM orders GROUP BY 1),
    d AS (SELECT year, count(*) AS n_dst FROM (
            SELECT year(o_orderdate) AS year FROM orders
            WHERE year(o_orderdate) <> 1995 AND NOT (year(o_orderdate) = 1997 AND o_orderkey % 100 = 0)
            UNION ALL SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) = 1999 AND o_orderkey % 100 = 0)
          GROUP BY 1)
    SELECT year, coalesce(n_src, 0) AS n_src, coalesce(n_dst, 0) AS n_dst,
           CASE WHEN n_dst IS NULL THEN 'missing' WHEN n_src IS NULL THEN 'unexpected'
                WHEN n_dst < n_src THEN 'short' WHEN n_dst > n_src THEN 'extra' ELSE 'ok' END AS status
    FROM s FULL JOIN d USING (year)
""")
def reconcile_counts(spark, sf):
    src = load(spark, sf, "orders", "o_orderkey", "o_orderdate").withColumn(
        "year", F.year("o_orderdate").cast("bigint")
    )
    path = scratch_path(spark, "loaded")
    kept = src.filter("year <> 1995 AND NOT (year = 1997 AND o_orderkey % 100 = 0)")
    again = src.filter("year = 1999 AND o_orderkey % 100 = 0")
    sinks.replace_partitions(kept.unionByName(again).drop("o_orderdate"), path, ["year"])
    dst = files.partitioned(spark, path).withColumn("year", F.col("year").cast("bigint"))
    return quality.reconcile(src, dst, ["year"])


@query("batch_dedup", "SELECT event_id, user_id, value FROM events")
def batch_dedup(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "value").withColumn("arrival", F.lit(0))
    replay = events.filter("event_id % 5 = 0").withColumns(
        {"arrival": F.lit(1), "value": F.col("value") + 1}
    )
    return quality.first_copy(events.unionByName(replay), ["event_id"], "arrival").drop("arrival")


@query("medallion_gold", """
    SELECT n_name, event_type, count(*) AS n, round(sum(value), 2) AS value
    FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
""")
def medallion_gold(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "event_type", "value").withColumn("arrival", F.lit(0))
    bronze = events.unionByName(events.filter("event_id % 3 = 0").withColumn("arrival", F.lit(1)))
    clean = quality.first_copy(bronze, ["event_id"], "arrival")
    # Summed per user first: a busy user meets the dimensions as one row per type.
    silver = clean.groupBy("user_id", "event_type").agg(
        F.count("*").alias("n"), F.sum("value").alias("value")
    ).join(
        load(spark, sf, "customer", "c_custkey", "c_nationkey"), F.expr("user_id = c_custkey")
    ).join(load(spark, sf, "nation", "n_nationkey", "n_name"), F.expr("c_nationkey = n_nationkey"))
    return silver.groupBy("n_name", "event_type").agg(
        F.sum("n").alias("n"), F.round(F.sum("value"), 2).alias("value")
    )


@query("volume_route", """
    SELECT year(l_shipdate) AS year, count(*) AS n,
           CASE WHEN count(*) > 9000 THEN 'large' ELSE 'standard' END AS route FROM lineitem GROUP BY 1
""")
def volume_route(spark, sf):
    items = load(spark, sf, "lineitem", "l_shipdate").select(F.year("l_shipdate").cast("bigint").alias("year"))
    return quality.route_by_volume(items, "year", 9000)


@query("bronze_to_parquet", """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum(user_id)::BIGINT AS users FROM events
    WHERE event_id % 10 > 3 GROUP BY 1
""")
def bronze_to_parquet(spark, sf):
    rows = damaged(load(spark, sf, "events")).withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    topic = topics.as_topic(rows, "events", F.col("user_id"), F.col("value"), F.col("event_id"), F.col("ts"), 4)
    good, _ = quality.split_bad(topic, "value", REQUIRED)
    typed = good.withColumn("timestamp", scalars.parse_iso(F.col("timestamp"))).filter("timestamp IS NOT NULL")
    path = scratch_path(spark, "silver")
    sinks.write_hourly(
        typed.withColumn("ms", scalars.utc_millis(F.col("timestamp"))), "ms", path
    )
    back = sinks.read_hourly(spark, path)
    return back.groupBy(F.concat_ws("-", "year", "month", "day").alias("day")).agg(
        F.count("*").alias("n"), F.sum("user_id").alias("users")
    )
