"""Registered row-level changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import arranging, changes, stored
from millrace.plans.registry import query
from millrace.session import scratch_path, write_through
from millrace.sources import sinks
from millrace.tables import load


@query("update_where", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 1000
           THEN round(c_acctbal + 250, 2) ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
""")
def update_where(spark, sf):
    return changes.update_where(
        load(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment"),
        F.expr("c_mktsegment = 'BUILDING' AND c_acctbal < 1000"),
        {"c_acctbal": F.round(F.col("c_acctbal") + 250, 2)},
    )


@query("delete_where", """
    SELECT o_orderkey, status FROM (
      SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders)
    WHERE status IS NULL OR status <> 'F'
""")
def delete_where(spark, sf):
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderstatus").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status"
    )
    return changes.delete_where(orders, F.col("status") == "F")


@query("gdpr_erase", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 50 = 7)
""")
def gdpr_erase(spark, sf):
    erased = load(spark, sf, "customer", "c_custkey").filter("c_custkey % 50 = 7").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return changes.erase_keys(load(spark, sf, "orders", "o_orderkey", "o_custkey"), erased, "o_custkey")


@query("merge_upsert", """
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN round(c_acctbal + 100, 2) ELSE c_acctbal END AS c_acctbal
    FROM customer WHERE c_custkey % 7 <> 1
    UNION ALL
    SELECT c_custkey + 1000000000, 'new ' || c_name, c_acctbal FROM customer WHERE c_custkey % 7 = 2
""")
def merge_upsert(spark, sf):
    target = load(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal")
    stage = arranging.union_all(
        target.filter("c_custkey % 7 = 0").withColumn("action", F.lit("UPDATE")).withColumn(
            "c_acctbal", F.round(F.col("c_acctbal") + 100, 2)
        ),
        target.filter("c_custkey % 7 = 1").withColumn("action", F.lit("DELETE")),
        target.filter("c_custkey % 7 = 2").withColumn("action", F.lit("INSERT")).withColumns({
            "c_custkey": F.col("c_custkey") + 1_000_000_000,
            "c_name": F.concat(F.lit("new "), F.col("c_name")),
        }),
    )
    return changes.merge(
        target, stage, ["c_custkey"],
        matched=[
            (F.col("s.action") == "DELETE", None),
            (F.col("s.action") == "UPDATE", {"c_acctbal": F.col("s.c_acctbal")}),
        ],
        insert={c: F.col(f"s.{c}") for c in target.columns},
    )


def _log(spark, sf):
    base = load(spark, sf, "orders", "o_orderkey", "o_totalprice")

    def delta(write_id, op, condition, add):
        return base.filter(condition).select(
            "o_orderkey", (F.col("o_totalprice") + add).alias("o_totalprice"),
            F.lit(write_id).alias("write_id"), F.lit(op).alias("op"),
        )

    return arranging.union_all(
        delta(1, "I", "true", 0), delta(2, "U", "o_orderkey % 5 = 0", 1),
        delta(3, "U", "o_orderkey % 3 = 0", 2), delta(4, "D", "o_orderkey % 7 = 0", 0),
        delta(5, "U", "o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0", 4),
    )


LOG_SQL = """
    WITH log AS (
      SELECT o_orderkey, o_totalprice, 1 AS write_id, 'I' AS op FROM orders
      UNION ALL SELECT o_orderkey, o_totalprice + 1, 2, 'U' FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT o_orderkey, o_totalprice + 2, 3, 'U' FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey, o_totalprice, 4, 'D' FROM orders WHERE o_orderkey % 7 = 0
      UNION ALL SELECT o_orderkey, o_totalprice + 4, 5, 'U' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY write_id DESC) AS rn
      FROM log WHERE write_id <> 3 AND write_id BETWEEN {lo} AND {hi})
    SELECT o_orderkey, o_totalprice, write_id, op FROM ranked WHERE rn = 1
"""


def _aborted(spark):
    return spark.sql("SELECT 3 AS write_id")


@query("snapshot_as_of", LOG_SQL.format(lo=1, hi=4) + " AND op <> 'D'")
def snapshot_as_of(spark, sf):
    return changes.snapshot(_log(spark, sf), ["o_orderkey"], 4, _aborted(spark))


@query("change_feed_split", """
    SELECT c_custkey, 'D' AS op, c_name, c_acctbal FROM customer WHERE c_custkey % 6 IN (0, 1)
    UNION ALL SELECT c_custkey, 'I', c_name, c_acctbal + 5 FROM customer WHERE c_custkey % 6 = 0
    UNION ALL SELECT c_custkey + 1000000000, 'I', c_name, c_acctbal FROM customer WHERE c_custkey % 6 = 2
""")
def change_feed_split(spark, sf):
    old = load(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal")
    changed = old.filter("c_custkey % 6 <> 1").withColumn(
        "c_acctbal", F.expr("CASE WHEN c_custkey % 6 = 0 THEN c_acctbal + 5 ELSE c_acctbal END")
    )
    added = old.filter("c_custkey % 6 = 2").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    return changes.change_feed(old, changed.unionByName(added))


@query("compact_minor", LOG_SQL.format(lo=2, hi=5))
def compact_minor(spark, sf):
    return changes.minor_compaction(_log(spark, sf), ["o_orderkey"], 2, 5, _aborted(spark))


@query("compact_major", LOG_SQL.format(lo=1, hi=5) + " AND op <> 'D'")
def compact_major(spark, sf):
    return write_through(changes.snapshot(_log(spark, sf), ["o_orderkey"], None, _aborted(spark)), "new-base")


def _stored_orders(spark, sf):
    path = scratch_path(spark, "orders")
    orders = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    sinks.parquet(orders.hint("rebalance", "o_orderpriority"), path, ["o_orderpriority"])
    return path


@query("table_update", """
    SELECT o_orderkey, o_custkey, o_orderpriority,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
""")
def table_update(spark, sf):
    path = _stored_orders(spark, sf)
    condition = F.expr("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey % 2 = 0")
    stored.update(spark, path, ["o_orderpriority"], condition, {"o_totalprice": F.col("o_totalprice") + 1})
    return spark.read.parquet(path)


@query("table_delete", """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    WHERE NOT (o_orderpriority = '5-LOW' OR o_orderpriority = '1-URGENT' AND o_totalprice < 100000)
""")
def table_delete(spark, sf):
    path = _stored_orders(spark, sf)
    stored.delete(spark, path, ["o_orderpriority"],
                  F.expr("o_orderpriority = '5-LOW' OR o_orderpriority = '1-URGENT' AND o_totalprice < 100000"))
    return spark.read.parquet(path)


@query("table_merge", """
    WITH s AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice * 2 AS p FROM orders WHERE o_orderkey % 10 = 0 AND o_orderpriority = '2-HIGH'
               UNION ALL SELECT -o_orderkey - 1, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 3)
    SELECT o_orderkey, o_custkey, coalesce(p, o_totalprice) AS o_totalprice, o_orderpriority FROM orders LEFT JOIN s ON k = o_orderkey
    WHERE NOT coalesce(c % 3 = 0, false)
    UNION ALL SELECT k, c, p, '6-NEW' FROM s WHERE k < 0
""")
def table_merge(spark, sf):
    """Doubled prices, some of them deletes, and new orders for a partition of their own."""
    path = _stored_orders(spark, sf)
    orders = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    changed = orders.filter("o_orderkey % 10 = 0 AND o_orderpriority = '2-HIGH'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    new = orders.filter("o_orderkey % 10 = 3").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    source = changed.unionByName(new).drop("o_orderpriority")
    stored.merge(spark, path, ["o_orderpriority"], source, ["o_orderkey"],
                 [(F.expr("s.o_custkey % 3 = 0"), None), (None, {"o_totalprice": F.col("s.o_totalprice")})],
                 {"o_orderkey": F.col("s.o_orderkey"), "o_custkey": F.col("s.o_custkey"),
                  "o_totalprice": F.col("s.o_totalprice"), "o_orderpriority": F.lit("6-NEW")})
    return spark.read.parquet(path)
