"""Registered scans and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.session import scratch_name, scratch_path
from millrace.sources import files, sinks, synth, topics
from millrace.tables import load, path_of
from millrace.plans.registry import query


@query("scan_csv_infer", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
""")
def scan_csv_infer(spark, sf):
    path = scratch_path(spark, "orders-csv")
    sinks.csv(load(spark, sf, "orders"), path, header=True)
    df = files.csv_inferred(spark, path)
    return df.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"),
        "o_custkey": F.col("o_custkey").cast("bigint"),
        "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
    })


@query("scan_delimited", """
    SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_nationkey END AS s_nationkey,
           s_acctbal FROM supplier
""")
def scan_delimited(spark, sf):
    path = scratch_path(spark, "supplier-text")
    damaged = load(spark, sf, "supplier").withColumn(
        "s_nationkey",
        F.when(F.col("s_suppkey") % 10 == 0, "n/a").otherwise(F.col("s_nationkey").cast("string")),
    )
    sinks.csv(damaged, path)
    return files.delimited(
        spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    )


@query("scan_text_lines", """
    SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    GROUP BY line
""")
def scan_text_lines(spark, sf):
    path = scratch_path(spark, "documents-text")
    load(spark, sf, "documents", "text").write.text(path)
    lines = files.text_lines(spark, path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


EVENT_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


@query("scan_json_lines", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json_lines(spark, sf):
    path = scratch_path(spark, "events-json")
    sinks.json_lines(load(spark, sf, "events"), path)
    return files.json_lines(spark, path, EVENT_DDL)


@query("scan_parquet", """
    SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_returnflag
""")
def scan_parquet(spark, sf):
    df = files.parquet(spark, path_of(sf, "lineitem"))
    return df.filter("l_shipdate >= TIMESTAMP_NTZ'1997-01-01'").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query("scan_orc", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def scan_orc(spark, sf):
    path = scratch_path(spark, "part-orc")
    sinks.orc(load(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), path)
    return files.orc(spark, path)


@query("scan_multifile_counts", """
    SELECT true AS many_files, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM orders
""")
def scan_multifile_counts(spark, sf):
    path = sinks.many_small_files(load(spark, sf, "orders"), 12, "orders-files", folder_files=20_000)
    df = files.multi_file(spark, path).select("file", "o_orderkey")
    return df.agg(
        (F.min("file") < F.max("file")).alias("many_files"), F.count("*").alias("n_rows"),
        F.count_distinct("o_orderkey").alias("n_keys"),
    )


@query("scan_discovered_partitions", """
    SELECT year(o_orderdate) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
""")
def scan_discovered_partitions(spark, sf):
    path = scratch_path(spark, "orders-by-year")
    df = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate")
    sinks.parquet(
        df.select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("year"))
        .hint("rebalance", "year"), path, ["year"],
    )
    table = files.register_partitions(
        spark, scratch_name("orders"), "o_orderkey BIGINT, o_totalprice DOUBLE, year BIGINT", "year", path
    )
    return table.groupBy("year").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("topic_as_table", """
    SELECT CAST(event_id % 4 AS INTEGER) AS _partition, event_id // 4 AS _offset,
           CAST(user_id AS VARCHAR) AS _key, props AS _message,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def topic_as_table(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "props", "ts")
    topic = topics.as_topic(
        events, "clicks", F.col("user_id"), F.col("props"), F.col("event_id"), F.col("ts"), 4
    )
    return topics.topic_table(topic, "k BIGINT")


@query("gen_skewed", """
    SELECT CASE WHEN l_orderkey % 100 < 95 THEN 'KEY_SKEW' ELSE CAST(l_orderkey AS VARCHAR) END AS join_key,
           count(*) AS n FROM lineitem GROUP BY 1
""")
def gen_skewed(spark, sf):
    tx = synth.skewed_transactions(load(spark, sf, "lineitem", "l_orderkey"), "l_orderkey")
    return tx.groupBy("join_key").agg(F.count("*").alias("n"))


@query("gen_users_cities", """
    SELECT c_custkey AS id, 'User_' || c_custkey AS name,
           CAST((c_custkey % 1000003 * 7921 + 104729) % 1000003 % 50 + 18 AS INTEGER) AS age,
           CAST(CASE WHEN c_custkey % 10 = 0 THEN 999 ELSE c_custkey % 5 END AS INTEGER) AS city_id
    FROM customer
""")
def gen_users_cities(spark, sf):
    return synth.users(load(spark, sf, "customer", "c_custkey"), "c_custkey")


BENCH_CTE = """
    WITH v AS (SELECT [12.5, 8.4, 19.1, 4.3, 10.0, 15.6, 25.1, 3.2, 14.8, 20.0]::DOUBLE[] AS v),
    d AS (SELECT o_orderkey % 10 + 1 AS s1, o_orderkey // 10 % 10 + 1 AS s2,
                 o_orderkey // 100 % 10 + 1 AS s3, o_orderkey // 1000 % 10 + 1 AS s4 FROM orders),
    logs AS (
      SELECT s1 + s2 * 10 + s3 * 100 AS log_id,
             CASE WHEN s1 % 3 = 0 THEN 'ERROR' WHEN s1 % 3 = 1 THEN 'INFO' ELSE 'WARN' END AS log_level,
             v[s1] * 1.5 + v[s2] * 0.8 + v[s3] * 0.2 + v[s4] * 0.1 AS response_time
      FROM d, v)
"""


@query("gen_benchmark_logs", BENCH_CTE + """
    SELECT log_id, log_level, round(response_time, 4) AS response_time FROM logs
""")
def gen_benchmark_logs(spark, sf):
    logs = synth.benchmark_logs(load(spark, sf, "orders", "o_orderkey"), "o_orderkey")
    return logs.withColumn("response_time", F.round("response_time", 4))


MIX = "(({i} % 1000003 * {a} + {b}) % 1000003 % {m})"


def _mix(i: str, salt: int, m: int) -> str:
    return MIX.format(i=i, a=7919 + 2 * salt, b=salt * 104729, m=m)


@query("gen_clickstream", f"""
    SELECT event_id,
      ['view','click','add_to_cart','remove_from_cart','purchase'][{_mix('event_id', 2, 5)} + 1] AS event_type,
      ['/home','/products','/products/electronics','/products/apparel','/cart','/checkout','/payment',
       '/order-confirmation'][{_mix('event_id', 3, 8)} + 1] AS page_url,
      ['mobile-ios','mobile-android','desktop-chrome','desktop-firefox','tablet-safari'][{_mix('event_id', 4, 5)} + 1] AS device,
      concat_ws('.', {_mix('event_id', 5, 223)} + 1, {_mix('event_id', 6, 256)}, {_mix('event_id', 7, 256)},
                {_mix('event_id', 8, 254)} + 1) AS ip_address
    FROM events
""")
def gen_clickstream(spark, sf):
    return synth.clickstream(load(spark, sf, "events", "event_id"), "event_id")


@query("gen_order_events", f"""
    SELECT 'cust_' || ({_mix('o_orderkey', 9, 10)} + 1) AS key,
           CASE WHEN {_mix('o_orderkey', 11, 100)} < 5 THEN 'FAILED' ELSE 'CREATED' END AS status,
           count(*) AS n, round(sum(10.0 + {_mix('o_orderkey', 10, 99001)} / 100.0), 2) AS amount,
           min('order_' || o_orderkey) AS first_order
    FROM orders GROUP BY 1, 2
""")
def gen_order_events(spark, sf):
    messages = synth.order_events(load(spark, sf, "orders", "o_orderkey"), "o_orderkey").select("key", "payload")
    parsed = messages.select(
        "key", F.from_json("payload", "orderId STRING, amount DOUBLE, status STRING").alias("d")
    ).select("key", "d.*")
    return parsed.groupBy("key", "status").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("amount"),
        F.min("orderId").alias("first_order"),
    )
