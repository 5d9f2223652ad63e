"""Results must not change, and work must spread, when one key holds most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.operators.ordered import (
    CHUNK, dense_ids, exact_quantiles, ordered, with_previous, with_row_number,
    with_running_max, with_running_sum,
)
from millrace.streaming import windows


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 holds two thirds of the rows, one key is NULL, some values are NULL."""
    return spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 < 2, 7).when(F.col("id") % 50 == 2, None).otherwise(F.col("id") % 11).alias("k"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 37 % 1009)).alias("v"),
    )


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ordered_steps_equal_plain_windows(skewed):
    w = Window.partitionBy("k").orderBy("id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "id", "k", "v", F.lag("v").over(w).alias("p"), F.sum("v").over(upto).alias("s"),
        F.max("v").over(upto).alias("m"), F.row_number().over(w).cast("bigint").alias("r"),
    )
    # Only the large key spread; every key spread; none spread.
    for share in (0.3, 1e-9, 1.0):
        o = with_previous(ordered(skewed, ["k"], ["id"], 16, share), p="v")
        o = with_running_max(with_running_sum(o, "s", F.col("v")), "m", F.col("v"))
        same(with_row_number(o, "r").rows().select(want.columns), want)


def test_one_key_is_spread_over_chunks(skewed):
    o = ordered(skewed, ["k"], ["id"], 16)
    sizes = [r["n"] for r in o.df.groupBy(CHUNK, "k").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 30_000 / 8
    assert o.df.filter("k = 7").select(CHUNK).distinct().count() > 8
    assert o.df.filter("k <> 7").select(CHUNK).distinct().collect()[0][0] == 0


def test_dense_ids_without_gaps(skewed):
    ids = dense_ids(skewed.select(F.col("id").alias("x")), ["x"])
    assert ids.filter("row_id <> x + 1").count() == 0


def test_quantiles_equal_percentile(skewed):
    got = exact_quantiles(skewed, ["k"], "v", {"a": 0.5, "b": 0.99, "c": 0.0, "d": 1.0})
    want = skewed.groupBy("k").agg(*[F.expr(f"percentile(v, {q})").alias(n) for n, q in (("a", 0.5), ("b", 0.99), ("c", 0), ("d", 1))])
    rounded = [F.round(c, 6).alias(c) for c in "abcd"]
    same(got.select("k", *rounded), want.select("k", *rounded))
    one = exact_quantiles(skewed, [], "v", {"a": 0.25}).first()["a"]
    assert abs(one - skewed.selectExpr("percentile(v, 0.25)").first()[0]) < 1e-9


def test_salted_and_plain_join_agree(spark, skewed):
    dim = spark.range(11).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
    dim = dim.union(dim.filter("k < 3"))  # more than one row for some keys
    plain = skewed.join(dim, "k")
    same(joins.salted_join(skewed, dim, "k", 8).select(plain.columns), plain)
    for strategy in (joins.sort_merge_join, joins.shuffle_hash_join, joins.broadcast_join):
        same(strategy(skewed, dim, "k").select(plain.columns), plain)
    same(joins.broadcast_join(skewed, dim, "k", rows=3).select(plain.columns), plain)


def test_salt_spreads_the_hot_key_only(spark, skewed):
    dim = spark.range(11).select(F.col("id").alias("k"))
    left, right = joins.salt_pair(skewed, dim, "k", 8, 0.3)
    assert left.filter("k = 7").select("_salt").distinct().count() == 8
    assert left.filter("k <> 7").select("_salt").distinct().count() == 1
    assert right.count() == 10 + 8


def test_fanout_equals_the_join(spark, skewed):
    small = skewed.filter("id < 600").select("k")
    want = small.join(small.withColumnRenamed("k", "j"), F.expr("k = j")).groupBy("k").agg(F.count("*").alias("n_pairs"))
    same(joins.fanout_count(small, small, "k"), want)


def test_like_join_equals_nested_loop(spark):
    texts = spark.createDataFrame(
        [(1, "the quick brown fox"), (2, "100% sure_thing"), (3, ""), (4, None), (5, "ab"), (6, "naïve café"), (7, "aaa aaa aaa")],
        "tid INT, txt STRING",
    )
    patterns = spark.createDataFrame(
        [(1, "quick"), (2, "q%x"), (3, ""), (4, None), (5, "%"), (6, "_b"), (7, "absent"), (8, "a"), (9, "é"), (10, "e_t"),
         (11, "\\%"), (12, "\\_th"), (13, "aaa"), (14, "ick%fo"), (15, "a%a%a_a%a"), (16, "fox%fox"), (17, "___"), (18, "a"),
         (19, "_%\\%%s")], "pid INT, pat STRING",
    )
    want = texts.crossJoin(patterns).filter(F.expr("txt LIKE concat('%', pat, '%')")).select("tid", "pid")
    same(joins.like_join(texts, "tid", "txt", patterns, "pid", "pat"), want)
    same(joins.like_join(texts, "tid", "txt", patterns, "pid", "pat", pattern_bytes=0), want)
    none = patterns.limit(0)
    assert joins.like_join(texts, "tid", "txt", none, "pid", "pat").count() == 0
    assert joins.like_join(texts.limit(0), "tid", "txt", patterns, "pid", "pat").count() == 0
    with pytest.raises(ValueError, match="backslash"):
        joins.like_join(texts, "tid", "txt", patterns.selectExpr("pid", "'\\\\q' AS pat"), "pid", "pat")


def test_interval_join_equals_range_join(spark):
    base = spark.range(400).select(
        F.col("id").alias("i"), F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 5).alias("k"),
        (F.timestamp_seconds(F.col("id") * 97 % 5000)).cast("timestamp_ntz").alias("t"),
    )
    a = base.select("k", F.col("i").alias("ai"), F.col("t").alias("at"))
    b = base.select(F.col("k").alias("k2"), F.col("i").alias("bi"), F.col("t").alias("bt"))
    for lo, hi in ((0, 60), (-30, 30), (10, 10)):
        want = a.join(b, F.expr(f"k = k2 AND bt >= at + INTERVAL '{lo}' SECOND AND bt <= at + INTERVAL '{hi}' SECOND")).select("ai", "bi")
        got = joins.interval_join(a, b.withColumnRenamed("k2", "k"), "k", "at", "bt", lo, hi)
        same(got.select("ai", "bi"), want)


def test_sessions_of_a_busy_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 9).alias("k"), "id",
        F.timestamp_seconds(F.col("id") * 7 + F.when(F.col("id") % 100 > 90, 900).otherwise(0)).cast("timestamp_ntz").alias("ts"),
    )
    got = windows.sessionize(df, "k", "ts", "id", 300).select("k", "session_start", "session_end", "n")
    want = df.groupBy("k", F.session_window("ts", "300 seconds").alias("w")).agg(F.count("*").alias("n")).select(
        "k", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    same(got, want)


def test_quantiles_of_awkward_values(spark):
    inf, nan = float("inf"), float("nan")
    data = [("a", v) for v in (-inf, -1.7e308, 1.7e308, inf, 0.0, 5e-324)] + [("b", nan), ("b", 1.0), ("b", nan)] + [("c", None)] \
        + [(None, float(i)) for i in range(101)] + [("d", 2.5)] * 1000 + [("e", 10.0 ** -i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    got = {r["k"]: (r["lo"], r["mid"], r["hi"]) for r in exact_quantiles(df, ["k"], "v", {"lo": 0.0, "mid": 0.4, "hi": 1.0}).collect()}
    assert "c" not in got and got["d"] == (2.5, 2.5, 2.5) and got[None] == (0.0, 40.0, 100.0)
    assert got["a"] == (-inf, 0.0, inf) and got["b"][0] == 1.0 and got["b"][2] != got["b"][2]
    want = sorted(10.0 ** -i for i in range(300))
    assert got["e"] == (want[0], pytest.approx(want[119] + 0.6 * (want[120] - want[119])), 1.0)
    assert exact_quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).collect() == []
    whole = spark.range(1001).select((F.col("id") * 8 % 1001).alias("v"))
    assert exact_quantiles(whole, [], "v", {"m": 0.5, "p": 0.999}).first()[:] == (500.0, 999.0)


def test_quantiles_of_many_keys_stay_in_tables(spark, monkeypatch):
    from millrace.operators import ordered as module

    monkeypatch.setattr(module, "FEW", 10)
    df = spark.range(5000).select((F.col("id") % 40).alias("k"), (F.col("id") * 37 % 1009).cast("double").alias("v"))
    got = exact_quantiles(df, ["k"], "v", {"m": 0.5}).select("k", F.round("m", 6).alias("m"))
    same(got, df.groupBy("k").agg(F.round(F.expr("percentile(v, 0.5)"), 6).alias("m")))


def test_quantiles_do_not_sort_values(spark, skewed):
    from millrace import controls

    plan = controls.executed_plan(exact_quantiles(skewed, ["k"], "v", {"m": 0.5}))
    assert "Sort [v" not in plan and "Sort [_v" not in plan


def test_empty_tables_have_no_large_keys(spark):
    from millrace.operators import metrics

    none = spark.createDataFrame([], "k int, id long, ts timestamp_ntz, v double")
    assert windows.sessionize(none, "k", "ts", "id", 300).collect() == []
    assert with_row_number(ordered(none, ["k"], ["id"]), "n").rows().collect() == []
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    assert joins.salted_join(none, dim, "k").collect() == []
    assert joins.salted_join(none.filter("v > 3"), dim, "k").collect() == []


def test_salts_meet_over_key_types(spark):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 5).cast("int").alias("k"), "id")
    dim = spark.range(9).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name")).union(spark.createDataFrame([(1 << 40, 1)], "k long, name long"))
    plain = fact.join(dim, "k")
    same(joins.salted_join(fact, dim, "k", 4).select(plain.columns), plain)
