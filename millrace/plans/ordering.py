"""Registered orderings, windows and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import arranging, changes, text
from millrace.operators.ordered import dense_ids, ordered, with_previous
from millrace.plans.registry import query
from millrace.session import scratch_path, shuffle_width
from millrace.sources import sinks
from millrace.tables import load


@query("dense_row_ids", """
    SELECT o_orderkey, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_id FROM orders
""")
def dense_row_ids(spark, sf):
    orders = load(spark, sf, "orders", "o_orderkey", "o_totalprice").withColumn(
        "neg_price", -F.col("o_totalprice")
    )
    return dense_ids(orders, ["neg_price", "o_orderkey"]).drop("neg_price")


@query("log_compaction", """
    SELECT user_id, event_id, value FROM (
      SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND value IS NOT NULL
""")
def log_compaction(spark, sf):
    log = load(spark, sf, "events", "user_id", "event_id", "value").withColumn(
        "value", F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END")
    )
    return changes.compact_log(log, ["user_id"], "event_id", "value")


ORDER_STEPS = {"signup": 1, "view": 2, "click": 3, "purchase": 4}


@query("order_transitions", """
    SELECT event_type, previous, count(*) AS n, sum(CAST(legal AS INTEGER))::BIGINT AS n_legal FROM (
      SELECT event_type, previous,
             coalesce(list_position(['signup','view','click','purchase'], event_type)
                      - list_position(['signup','view','click','purchase'], previous) IN (0, 1),
                      previous IS NULL AND event_type = 'signup') AS legal
      FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
            FROM events WHERE event_type <> 'error'))
    GROUP BY ALL
""")
def order_transitions(spark, sf):
    steps = load(spark, sf, "events", "user_id", "event_id", "event_type").filter("event_type <> 'error'")
    rows = with_previous(ordered(steps, ["user_id"], ["event_id"]), previous="event_type").rows()
    rank = F.create_map(*[F.lit(x) for pair in ORDER_STEPS.items() for x in pair])
    step = rank[F.col("event_type")] - rank[F.col("previous")]
    legal = F.coalesce(step.isin(0, 1), F.col("previous").isNull() & (F.col("event_type") == "signup"))
    return rows.groupBy("event_type", "previous").agg(
        F.count("*").alias("n"), F.sum(legal.cast("int")).alias("n_legal")
    )


@query("audit_latest", """
    SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20
""")
def audit_latest(spark, sf):
    return arranging.latest(load(spark, sf, "events", "event_id", "ts", "user_id", "event_type"), "ts", "event_id", 20)


@query("sort_global", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sort_global(spark, sf):
    return load(spark, sf, "supplier", "s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query("topk_groups", """
    SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10
""")
def topk_groups(spark, sf):
    return arranging.top_groups(load(spark, sf, "lineitem", "l_partkey"), ["l_partkey"], 10)


def _totals(parts):
    """Every key sits in one partition only when the keys per partition add up to the keys."""
    return parts.agg(
        F.count("*").alias("n_parts"), F.sum("n").alias("n_rows"), F.sum("n_keys").alias("n_keys")
    )


PARTS_SQL = """
    SELECT CAST(8 AS BIGINT) AS n_parts, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders
"""


@query("cluster_by_partition_stats", "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders")
def cluster_by_partition_stats(spark, sf):
    rows = arranging.cluster_by(load(spark, sf, "orders", "o_custkey", "o_orderkey"), shuffle_width(spark), "o_custkey")
    return _totals(rows.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_keys")
    )).drop("n_parts")


@query("alphabet_partition", """
    WITH w AS (
      SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g')), '\\s+')) AS word
        FROM documents) WHERE word <> '' GROUP BY word)
    SELECT CASE WHEN word[1] BETWEEN 'a' AND 'm' THEN 0 WHEN word[1] BETWEEN 'n' AND 'z' THEN 1 ELSE 2 END AS part,
           count(*) AS n_words, sum(n)::BIGINT AS n_tokens FROM w GROUP BY 1
""")
def alphabet_partition(spark, sf):
    counts = text.count_alnum(load(spark, sf, "documents", "text"), "text")
    lines = counts.select(
        F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value"),
        scalars.alphabet_part(F.col("word"), 3).alias("part"),
    )
    path = scratch_path(spark, "words")
    sinks.gzip_text(lines.hint("rebalance", "part"), path, "part")
    back = spark.read.text(path)
    return back.groupBy("part").agg(
        F.count("*").alias("n_words"),
        F.sum(F.split("value", "\t")[1].cast("bigint")).alias("n_tokens"),
    )


@query("hash_partition_balance", PARTS_SQL)
def hash_partition_balance(spark, sf):
    orders = load(spark, sf, "orders", "o_custkey")
    return _totals(orders.groupBy(F.pmod(F.hash("o_custkey"), F.lit(8)).alias("part")).agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_keys")
    ))


@query("bucket_sample", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 = 0")
def bucket_sample(spark, sf):
    return arranging.bucket_sample(load(spark, sf, "orders", "o_orderkey", "o_totalprice"), "o_orderkey", 1, 4)
