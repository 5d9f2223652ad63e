"""Mixing tables with many equal rows."""

from pyspark.sql import functions as F

from millrace.llm import mixing


def test_equal_rows_are_drawn_one_by_one(spark):
    """A third of the rows have no id and one size; sources still meet their targets, as do the applied copies."""
    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("w "), 20)).otherwise(
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).cast("int")))
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), text.alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("source"))
    equal = spark.range(900).select(F.lit(None).cast("long").alias("doc_id"), F.repeat(F.lit("w "), 7).alias("text"), F.lit("t").alias("source"))
    docs = docs.unionByName(equal)
    mixed = mixing.mix(docs)
    taken = {}
    for r in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k")).collect():
        assert abs(r["k"] - r["t"]) <= (2 if r["source"] != "t" else 3.5)
        taken[r["source"]] = r["k"]
    assert mixed.count() == 3900
    applied = mixing.apply(docs).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("k"))
    assert {r["source"]: r["k"] for r in applied.collect()} == taken


def test_many_equal_rows_are_numbered(spark):
    many = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(3).cast("long").alias("size"))
    assert sorted(r["_same"] for r in mixing._numbered(many).collect()) == list(range(10_000))
