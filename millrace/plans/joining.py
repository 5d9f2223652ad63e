"""Registered joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import files, sinks
from millrace.sources.synth import skewed_transactions
from millrace.tables import load


@query("join_filter_project", """
    SELECT c_custkey, c_name, n_name, c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000 AND n_regionkey < 3
""")
def join_filter_project(spark, sf):
    customer = load(spark, sf, "customer").filter(
        "c_mktsegment = 'BUILDING' AND c_acctbal > 1000"
    )
    nation = load(spark, sf, "nation").filter("n_regionkey < 3")
    return joins.join(customer, nation, F.expr("c_nationkey = n_nationkey")).select(
        "c_custkey", "c_name", "n_name", "c_acctbal"
    )


@query("join_broadcast", """
    SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def join_broadcast(spark, sf):
    orders = load(spark, sf, "orders", "o_custkey", "o_totalprice")
    customer = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    nation = load(spark, sf, "nation", "n_nationkey", "n_name")
    named = joins.broadcast_join(customer, nation, F.expr("c_nationkey = n_nationkey"))
    joined = joins.broadcast_join(orders, named, F.expr("o_custkey = c_custkey"))
    return joined.groupBy("n_name").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("join_sort_merge", """
    SELECT o_orderpriority, count(*) AS n_items,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority
""")
def join_sort_merge(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderpriority")
    joined = joins.sort_merge_join(items, orders, F.expr("l_orderkey = o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_items"),
        F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"),
    )


@query("join_shuffle_hash", """
    SELECT p_brand, count(*) AS n_items, sum(l_quantity) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def join_shuffle_hash(spark, sf):
    items = load(spark, sf, "lineitem", "l_partkey", "l_quantity")
    part = load(spark, sf, "part", "p_partkey", "p_brand")
    joined = joins.shuffle_hash_join(items, part, F.expr("l_partkey = p_partkey"))
    return joined.groupBy("p_brand").agg(
        F.count("*").alias("n_items"), F.sum("l_quantity").alias("quantity")
    )


@query("join_theta_like", """
    WITH words AS (
      SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part
      UNION SELECT DISTINCT substr(p_name, 1, 2) || '%' || right(p_name, 1) FROM part)
    SELECT word, count(*) AS n_parts, min(p_partkey) AS first_part
    FROM part JOIN words ON p_name LIKE '%' || word || '%' GROUP BY word
""")
def join_theta_like(spark, sf):
    part = load(spark, sf, "part", "p_partkey", "p_name")
    words = (
        part.select(F.explode(F.split("p_name", " ")).alias("word"))
        .union(part.select(F.concat(F.substring("p_name", 1, 2), F.lit("%"), F.right("p_name", F.lit(1)))))
        .distinct()
        .select("word", F.col("word").alias("pattern"))
    )
    pairs = joins.like_join(part, "p_partkey", "p_name", words, "word", "pattern")
    return pairs.groupBy("word").agg(
        F.count("*").alias("n_parts"), F.min("p_partkey").alias("first_part")
    )


@query("join_expr_key", """
    SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
    FROM (SELECT o_custkey + 100 AS shifted, o_totalprice FROM orders)
    JOIN customer ON c_custkey = shifted - 100
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def join_expr_key(spark, sf):
    orders = load(spark, sf, "orders", "o_custkey", "o_totalprice").select(
        (F.col("o_custkey") + 100).alias("shifted"), "o_totalprice"
    )
    customer = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    nation = load(spark, sf, "nation", "n_nationkey", "n_name")
    return (
        joins.join(orders, customer, F.expr("c_custkey = shifted - 100"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    )


@query("join_bucketed", """
    SELECT o_orderstatus, count(*) AS n_items, sum(l_quantity) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus
""")
def join_bucketed(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_quantity")
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    left, right = joins.bucketed_pair(items, orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    joined = joins.bucketed_join(spark, left, right, "l_orderkey")
    return joined.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_items"), F.sum("l_quantity").alias("quantity")
    )


@query("join_federated3", """
    SELECT event_id, ts, c_name, n_name
    FROM events JOIN customer ON user_id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE event_type = 'purchase'
    ORDER BY ts DESC, event_id DESC
""")
def join_federated3(spark, sf):
    clicks_path = scratch_path(spark, "clicks-json")
    users_path = scratch_path(spark, "users-orc")
    places_path = scratch_path(spark, "places-csv")
    sinks.json_lines(load(spark, sf, "events", "event_id", "ts", "user_id", "event_type"), clicks_path)
    load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey").write.orc(users_path)
    load(spark, sf, "nation", "n_nationkey", "n_name").write.csv(places_path)
    clicks = files.json_lines(
        spark, clicks_path, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"
    ).filter("event_type = 'purchase'")
    users = files.orc(spark, users_path)
    places = files.delimited(spark, places_path, "n_nationkey INT, n_name STRING")
    return (
        clicks.join(users, F.expr("user_id = c_custkey"))
        .join(places, F.expr("c_nationkey = n_nationkey"))
        .select("event_id", "ts", "c_name", "n_name")
        .orderBy(F.desc("ts"), F.desc("event_id"))
    )


@query("join_cross_store_limit", """
    SELECT o_orderkey, c_name, o_totalprice FROM orders
    JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def join_cross_store_limit(spark, sf):
    path = scratch_path(spark, "customer-orc")
    load(spark, sf, "customer", "c_custkey", "c_name").write.orc(path)
    orders = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").filter(
        "o_orderdate >= TIMESTAMP_NTZ'1998-01-01' AND o_orderdate < TIMESTAMP_NTZ'1999-01-01'"
    )
    return (
        orders.join(files.orc(spark, path), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "c_name", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(100)
    )


SKEW_SQL = """
    WITH tx AS (
      SELECT CASE WHEN l_orderkey % 100 < 95 THEN 'KEY_SKEW'
                  ELSE CAST(l_orderkey AS VARCHAR) END AS join_key,
             l_extendedprice AS amount FROM lineitem),
    lookup AS (
      SELECT CASE WHEN o_orderkey = 0 THEN 'KEY_SKEW'
                  ELSE CAST(o_orderkey AS VARCHAR) END AS join_key,
             o_orderpriority AS category FROM orders)
    SELECT category, count(*) AS n_rows, round(sum(amount), 2) AS amount
    FROM tx JOIN lookup USING (join_key) GROUP BY category
"""


def _skewed(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice")
    tx = skewed_transactions(items, "l_orderkey").select(
        "join_key", F.col("l_extendedprice").alias("amount")
    )
    lookup = load(spark, sf, "orders", "o_orderkey", "o_orderpriority").select(
        F.expr("CASE WHEN o_orderkey = 0 THEN 'KEY_SKEW' ELSE CAST(o_orderkey AS STRING) END").alias("join_key"),
        F.col("o_orderpriority").alias("category"),
    )
    return tx, lookup


def _by_category(joined):
    return joined.groupBy("category").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("amount"), 2).alias("amount")
    )


@query("join_skew_aqe", SKEW_SQL)
def join_skew_aqe(spark, sf):
    tx, lookup = _skewed(spark, sf)
    return _by_category(joins.sort_merge_join(tx, lookup, "join_key"))


@query("join_salted", SKEW_SQL)
def join_salted(spark, sf):
    tx, lookup = _skewed(spark, sf)
    return _by_category(joins.salted_join(tx, lookup, "join_key"))


@query("join_fanout_count", """
    WITH a AS (SELECT l_orderkey % 100 AS key FROM lineitem),
         b AS (SELECT o_orderkey % 100 AS key FROM orders)
    SELECT key, CAST(sum(na * nb) AS BIGINT) AS n_pairs
    FROM (SELECT key, count(*) AS na FROM a GROUP BY key)
    JOIN (SELECT key, count(*) AS nb FROM b GROUP BY key) USING (key) GROUP BY key
""")
def join_fanout_count(spark, sf):
    a = load(spark, sf, "lineitem", "l_orderkey").select((F.col("l_orderkey") % 100).alias("key"))
    b = load(spark, sf, "orders", "o_orderkey").select((F.col("o_orderkey") % 100).alias("key"))
    return joins.fanout_count(a, b, "key")


@query("join_dynamic_filter", """
    SELECT l_returnflag, count(*) AS n_items, round(sum(l_extendedprice), 2) AS price
    FROM lineitem WHERE l_orderkey IN (
      SELECT o_orderkey FROM orders
      WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)
    GROUP BY l_returnflag
""")
def join_dynamic_filter(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_returnflag", "l_extendedprice")
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    kept = joins.filtered_probe(
        items, orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey",
        F.expr("o_orderpriority = '1-URGENT' AND o_totalprice > 300000"),
    )
    return kept.groupBy("l_returnflag").agg(
        F.count("*").alias("n_items"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@query("join_row_product", """
    SELECT c_nationkey, r.k AS copy, count(*) AS n_rows
    FROM customer, (SELECT unnest(range(5)) AS k) r GROUP BY c_nationkey, r.k
""")
def join_row_product(spark, sf):
    customer = load(spark, sf, "customer", "c_nationkey")
    return (
        joins.multiply_rows(customer, 5).groupBy("c_nationkey", F.col("copy").cast("bigint").alias("copy"))
        .agg(F.count("*").alias("n_rows"))
    )
