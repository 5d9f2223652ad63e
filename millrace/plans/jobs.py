"""Registered batch jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import mask_hash
from millrace.operators import series, text
from millrace.plans.registry import query
from millrace.tables import load


@query("wordcount_alnum", """
    SELECT word, count(*) AS n FROM (
      SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g')), '\\s+')) AS word
      FROM documents) WHERE word <> '' GROUP BY word
""")
def wordcount_alnum(spark, sf):
    return text.count_alnum(load(spark, sf, "documents", "text"), "text")


@query("wordcount_alpha", """
    SELECT word, count(*) AS n FROM (
      SELECT lower(regexp_replace(unnest(regexp_split_to_array(text, '\\s+')), '[^a-zA-Z]', '', 'g')) AS word
      FROM documents) WHERE word <> '' GROUP BY word
""")
def wordcount_alpha(spark, sf):
    return text.count_alpha(load(spark, sf, "documents", "text"), "text")


@query("wordcount_sql_top", """
    SELECT word, count(*) AS n FROM (
      SELECT unnest(string_split(line, ' ')) AS word FROM (
        SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    GROUP BY word ORDER BY n DESC, word LIMIT 5
""")
def wordcount_sql_top(spark, sf):
    counts = text.count_spaced(load(spark, sf, "documents", "text"), "text")
    return counts.orderBy(F.desc("n"), "word").limit(5)


@query("pi_leibniz", """
    SELECT round(4 * sum(CASE WHEN o_orderkey % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END / (2 * o_orderkey + 1)), 6) AS pi FROM orders
""")
def pi_leibniz(spark, sf):
    out = series.pi_leibniz(load(spark, sf, "orders", "o_orderkey"), "o_orderkey")
    return out.select(F.round("pi", 6).alias("pi"))


@query("pi_sampling", """
    WITH p AS (SELECT (o_orderkey * 0.7548776662466927::DOUBLE) % 1 AS x, (o_orderkey * 0.5698402909980532::DOUBLE) % 1 AS y FROM orders)
    SELECT count(*) FILTER (WHERE x * x + y * y <= 1) AS inside, count(*) AS n,
           round(4 * count(*) FILTER (WHERE x * x + y * y <= 1) / count(*), 6) AS pi FROM p
""")
def pi_sampling(spark, sf):
    out = series.pi_sampling(load(spark, sf, "orders", "o_orderkey"), "o_orderkey")
    return out.withColumn("pi", F.round("pi", 6))


@query("payments_dashboard", """
    SELECT n_name AS country, count(*) AS tx_count, round(sum(o_totalprice), 2) AS tx_sum,
           count(DISTINCT sha256(substr(c_name, 10))) AS cards
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def payments_dashboard(spark, sf):
    customer = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey").select(
        "c_custkey", mask_hash(F.expr("substring(c_name, 10)")).alias("card_hash"), "c_nationkey"
    )
    clean = load(spark, sf, "orders", "o_custkey", "o_totalprice").join(
        customer, F.expr("o_custkey = c_custkey")
    ).join(load(spark, sf, "nation", "n_nationkey", "n_name"), F.expr("c_nationkey = n_nationkey"))
    return clean.groupBy(F.col("n_name").alias("country")).agg(
        F.count("*").alias("tx_count"), F.round(F.sum("o_totalprice"), 2).alias("tx_sum"),
        F.count_distinct("card_hash").alias("cards"),
    )
