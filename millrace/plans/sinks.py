"""Registered sinks: each writes, reads back and reports what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.plans.registry import query
from millrace.session import scratch_name, scratch_path
from millrace.sources import files, sinks
from millrace.tables import load


@query("sink_hourly_partitions", """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
           strftime(ts, '%H') AS hour, count(*) AS n
    FROM (SELECT CASE WHEN event_id % 50 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS ts FROM events)
    GROUP BY ALL
""")
def sink_hourly_partitions(spark, sf):
    path = scratch_path(spark, "hourly")
    events = load(spark, sf, "events", "event_id", "ts", "event_type").withColumn(
        "timestamp_ms",
        F.when(F.col("event_id") % 50 != 0, scalars.utc_millis(F.col("ts"))),
    )
    sinks.write_hourly(events, "timestamp_ms", path, default_ms=1_706_745_600_000)
    return sinks.read_hourly(spark, path).groupBy(*sinks.HOUR).agg(F.count("*").alias("n"))


@query("etl_filter_partition_write", """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
""")
def etl_filter_partition_write(spark, sf):
    path = scratch_path(spark, "completed")
    done = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority").filter(
        "o_orderstatus = 'F'"
    ).withColumn("ingested_at", F.current_timestamp())
    sinks.parquet(done.hint("rebalance", "o_orderpriority"), path, ["o_orderpriority"])
    return files.partitioned(spark, path).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("sink_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "customer-csv")
    sinks.csv(load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)
    return files.delimited(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE")


@query("sink_orc_partitioned", """
    SELECT p_brand, count(*) AS n, round(sum(p_retailprice), 2) AS price FROM part
    WHERE p_size > 10 GROUP BY p_brand
""")
def sink_orc_partitioned(spark, sf):
    path = scratch_path(spark, "part-by-brand")
    part = load(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    sinks.orc(part.hint("rebalance", "p_brand"), path, ["p_brand"], bloom="p_partkey")
    return files.orc(spark, path).filter("p_size > 10").groupBy("p_brand").agg(
        F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 2).alias("price")
    )


@query("dynamic_partition_insert", """
    SELECT status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
      SELECT CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'late' ELSE o_orderstatus END AS status,
             o_totalprice FROM orders)
    GROUP BY status
""")
def dynamic_partition_insert(spark, sf):
    path = scratch_path(spark, "by-status")
    orders = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    is_late = F.expr("o_orderstatus = 'F' AND o_orderdate < TIMESTAMP_NTZ'1996-01-01'")
    plain = orders.filter(~is_late).select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    sinks.replace_partitions(plain, path, ["status"])
    late = orders.filter(is_late)
    sinks.insert_static(late.select("o_orderkey", "o_totalprice"), path, status="late")
    return files.partitioned(spark, path).groupBy("status").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("insert_overwrite_reload", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 1
    UNION ALL SELECT -1, 'appended'
""")
def insert_overwrite_reload(spark, sf):
    name = scratch_name("reload")
    customer = load(spark, sf, "customer", "c_custkey", "c_name")
    first = customer.filter("c_custkey % 3 <> 1")
    sinks.create_table_as(first, name, scratch_path(spark, name))
    customer.filter("c_custkey % 3 = 1").write.mode("overwrite").insertInto(name, overwrite=True)
    spark.sql(f"INSERT INTO {name} VALUES (CAST(-1 AS BIGINT), 'appended')")
    return spark.table(name)


@query("ctas_summary", """
    SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_nationkey
""")
def ctas_summary(spark, sf):
    name = scratch_name("summary")
    summary = load(spark, sf, "customer", "c_nationkey", "c_acctbal").groupBy("c_nationkey").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    return sinks.create_table_as(summary, name, scratch_path(spark, name))


@query("idempotent_date_load", """
    SELECT dt, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
      SELECT strftime(o_orderdate, '%Y-%m') AS dt, o_totalprice FROM orders) GROUP BY dt
""")
def idempotent_date_load(spark, sf):
    path = scratch_path(spark, "by-date")
    orders = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("dt")
    )
    sinks.replace_partitions(orders, path, ["dt"])
    # The rerun of one year replaces its months instead of adding to them.
    sinks.replace_partitions(orders.filter("dt LIKE '1997-%'"), path, ["dt"])
    return files.partitioned(spark, path).select(
        F.col("dt").cast("string").alias("dt"), "o_totalprice"
    ).groupBy("dt").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("compact_small_files", "SELECT event_id, user_id, event_type, value FROM events")
def compact_small_files(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    path = sinks.many_small_files(events, 500, "landing")
    sinks.compact(spark, path)
    return spark.read.parquet(path)


@query("retention_window", """
    SELECT event_type, count(*) AS n FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type
""")
def retention_window(spark, sf):
    recent = sinks.keep_recent(load(spark, sf, "events", "ts", "event_type"), "ts", 7)
    return recent.groupBy("event_type").agg(F.count("*").alias("n"))


@query("view_over_aggregate", """
    SELECT c_mktsegment, n FROM (
      SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) WHERE n > 0
""")
def view_over_aggregate(spark, sf):
    name = scratch_name("segments")
    load(spark, sf, "customer", "c_mktsegment").groupBy("c_mktsegment").agg(
        F.count("*").alias("n")
    ).createOrReplaceTempView(name)
    return spark.sql(f"SELECT c_mktsegment, n FROM {name} WHERE n > 0")
