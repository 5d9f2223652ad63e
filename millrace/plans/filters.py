"""Registered projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import scalar, wildcard
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import files, sinks
from millrace.tables import load


@query("project_alias", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders
""")
def project_alias(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
    )


@query("filter_and_range", """
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 500 AND c_acctbal < 5000
    ORDER BY c_acctbal DESC, c_custkey LIMIT 50
""")
def filter_and_range(spark, sf):
    return (
        load(spark, sf, "customer").filter(
            "c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 500 AND c_acctbal < 5000"
        ).select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(50)
    )


@query("partition_pruned_filter", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = 1997 AND o_totalprice > 200000
""")
def partition_pruned_filter(spark, sf):
    path = scratch_path(spark, "orders-year")
    orders = load(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    sinks.parquet(orders.hint("rebalance", "year"), path, ["year"])
    return files.partitioned(spark, path).filter("year = 1997 AND o_totalprice > 200000").drop("year")


@query("text_match", """
    SELECT 'document' AS kind, doc_id AS id FROM documents WHERE lower(text) LIKE '%data%'
    UNION ALL SELECT 'page', page_id FROM pages WHERE lower(url) LIKE '%example.com/%page=%'
""")
def text_match(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text").filter(wildcard(F.col("text"), "*DATA*"))
    pages = load(spark, sf, "pages", "page_id", "url").filter(
        wildcard(F.col("url"), "*example.com/*page=*")
    )
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id")).union(
        pages.select(F.lit("page"), "page_id")
    )


@query("case_classify", """
    SELECT CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 10 THEN 'normal' ELSE 'small' END AS class,
           count(*) AS n FROM lineitem GROUP BY 1
""")
def case_classify(spark, sf):
    size = F.when(F.col("l_quantity") >= 40, "bulk").when(F.col("l_quantity") >= 10, "normal").otherwise("small")
    return load(spark, sf, "lineitem", "l_quantity").groupBy(size.alias("class")).agg(F.count("*").alias("n"))


@query("drop_empty_null", """
    SELECT doc_id, count(*) AS n_tokens FROM (
      SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents WHERE lang IS NOT NULL)
    WHERE token <> '' GROUP BY doc_id
""")
def drop_empty_null(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text", "lang").dropna(subset=["text", "lang"])
    tokens = docs.select("doc_id", F.explode(F.split("text", " ")).alias("token")).filter("token <> ''")
    return tokens.groupBy("doc_id").agg(F.count("*").alias("n_tokens"))


@query("future_clock_filter", """
    SELECT event_id, ts FROM (
      SELECT event_id, CASE WHEN event_id % 97 = 0 THEN ts + INTERVAL 40 DAY ELSE ts END AS ts FROM events)
    WHERE ts <= (SELECT max(ts) FROM events) + INTERVAL 5 MINUTE
""")
def future_clock_filter(spark, sf):
    events = load(spark, sf, "events", "event_id", "ts")
    now = scalar(events, F.max("ts"))
    shifted = events.withColumn(
        "ts", F.expr("CASE WHEN event_id % 97 = 0 THEN ts + INTERVAL 40 DAYS ELSE ts END")
    )
    return shifted.filter(F.col("ts") <= now + F.expr("INTERVAL 5 MINUTES"))


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(spark, sf):
    return load(spark, sf, "part", "p_partkey", "p_size").filter(F.col("p_size").between(10, 20))


@query("point_lookup", """
    SELECT event_id, ts, user_id, event_type FROM events
    WHERE event_id = (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) FROM events)
""")
def point_lookup(spark, sf):
    path = scratch_path(spark, "events-bloom")
    events = load(spark, sf, "events", "event_id", "ts", "user_id", "event_type")
    sinks.parquet_with_bloom(events, path, "event_id", events.count())  # ids are unique: Parquet footers know how many
    wanted = scalar(events, F.floor(F.max("event_id") / 2).cast("bigint"))
    return spark.read.parquet(path).filter(F.col("event_id") == wanted)
