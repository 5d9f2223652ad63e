"""Registered scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.plans.registry import query
from millrace.tables import load


@query("fn_string_cast", """
    SELECT p_partkey, concat(p_brand, '-', CAST(p_size AS VARCHAR)) AS label,
           TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no, upper(trim(p_name)) AS name FROM part
""")
def fn_string_cast(spark, sf):
    return load(spark, sf, "part", "p_partkey", "p_brand", "p_size", "p_name").select(
        "p_partkey", F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("label"),
        F.expr("try_cast(substring(p_brand, 7) AS INT)").alias("brand_no"),
        F.upper(F.trim("p_name")).alias("name"),
    )


@query("fn_math", """
    SELECT l_orderkey % 7 AS rem, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS charge,
           round(avg(l_extendedprice / l_quantity - l_tax), 4) AS unit
    FROM lineitem GROUP BY 1
""")
def fn_math(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    return items.groupBy((F.col("l_orderkey") % 7).alias("rem")).agg(
        F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)")), 2).alias("charge"),
        F.round(F.avg(F.expr("l_extendedprice / l_quantity - l_tax")), 4).alias("unit"),
    )


@query("fn_epoch_parts", """
    SELECT event_id, date_trunc('millisecond', ts) AS ts, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
           strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events
""")
def fn_epoch_parts(spark, sf):
    events = load(spark, sf, "events", "event_id", "ts")
    ms = scalars.utc_millis(F.col("ts"))
    return events.select("event_id", *[c.alias(n) for n, c in scalars.epoch_parts(ms).items()])


@query("fn_from_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def fn_from_json(spark, sf):
    events = load(spark, sf, "events", "event_id", "props")
    return events.select("event_id", F.from_json("props", "k BIGINT").alias("d")).select("event_id", "d.*")


@query("fn_to_json", """
    SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}'
           AS body FROM customer
""")
def fn_to_json(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", F.to_json(F.struct("c_custkey", "c_name", "c_nationkey")).alias("body")
    )


@query("fn_iso_parse", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END AS parsed FROM orders
""")
def fn_iso_parse(spark, sf):
    text = F.when(F.col("o_orderkey") % 20 == 0, F.lit("31/12/99")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return load(spark, sf, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", scalars.parse_iso(text).alias("parsed")
    )


@query("fn_seeded_random", """
    SELECT c_custkey, CAST('0x' || substr(md5('7:' || c_custkey), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS r FROM customer
""")
def fn_seeded_random(spark, sf):
    return load(spark, sf, "customer", "c_custkey").select("c_custkey", scalars.seeded_random(7, "c_custkey").alias("r"))
