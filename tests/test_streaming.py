"""Streams over files: what a stream gives must be what the table gives."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators.joins import interval_join
from millrace.session import ROCKSDB_PROVIDER, settings
from millrace.sources import topics
from millrace.streaming import runs, state, windows

DDL = "k STRING, ts TIMESTAMP_NTZ, i BIGINT"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def at(minute, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute, seconds=second)


@pytest.fixture
def arrivals(spark, tmp_path):
    """A landing folder; each call adds one file."""
    path = str(tmp_path / "landing")

    def add(*data):
        spark.createDataFrame(list(data), DDL).coalesce(1).write.mode("append").parquet(path)
        return path

    return add


def start(spark, df, tmp_path):
    return runs.to_parquet(df, str(tmp_path / "out"), str(tmp_path / "cp-out"))


def run(spark, df, tmp_path, mode="append", name="out"):
    out, cp = str(tmp_path / name), str(tmp_path / f"cp-{name}")
    if mode == "append":
        return runs.finish(runs.to_parquet(df, out, cp)), out
    return runs.finish(runs.to_batches(df, out, cp, mode)), out


def test_late_row_is_dropped_and_counted(spark, arrivals, tmp_path):
    def go(path):
        stream = runs.table_stream(spark, path, spark.read.parquet(path).schema)
        return run(spark, windows.window_counts(stream, "ts", ["k"], "10 minutes", None, "10 minutes"), tmp_path)

    go(arrivals(("a", at(0), 1), ("a", at(1), 2)))
    go(arrivals(("a", at(60), 3)))
    path = arrivals(("a", at(2), 4))
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema)
    query = start(spark, windows.window_counts(stream, "ts", ["k"], "10 minutes", None, "10 minutes"), tmp_path)
    assert runs.dropped_late(query) == 1
    assert rows(spark.read.parquet(str(tmp_path / "out")), "window_start", "n") == [(at(0), 2)]


def test_append_equals_the_closed_windows(spark, arrivals, tmp_path):
    path = arrivals(*[("ab"[i % 2], at(i), i) for i in range(100)])
    table = spark.read.parquet(path)
    stream = windows.window_counts(runs.table_stream(spark, path, table.schema), "ts", ["k"], "10 minutes", "5 minutes", "10 minutes")
    _, out = run(spark, stream, tmp_path)
    want = windows.emitted_windows(table, "ts", ["k"], "10 minutes", "5 minutes", "10 minutes")
    assert rows(spark.read.parquet(out), "window_start", "k", "n") == rows(want, "window_start", "k", "n")


def test_restart_and_upsert_log(spark, arrivals, tmp_path):
    def go(path):
        stream = runs.table_stream(spark, path, spark.read.parquet(path).schema)
        return run(spark, windows.window_counts(stream, "ts", ["k"], "1 hour", None, "1 day"), tmp_path, "update")[1]

    go(arrivals(("a", at(0), 1), ("b", at(5), 2)))
    log = go(arrivals(("a", at(10), 3)))
    keys = ["window_start", "window_end", "k"]
    assert rows(runs.latest_state(spark, log, keys), "k", "n") == [("a", 2), ("b", 1)]
    # Nothing new: a third run must not change a thing.
    go(str(tmp_path / "landing"))
    assert rows(runs.latest_state(spark, log, keys), "k", "n") == [("a", 2), ("b", 1)]


def test_folded_log_gives_the_same_state(spark, tmp_path):
    log = str(tmp_path / "log")
    for batch, data in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5)]]):
        spark.createDataFrame(data, "k STRING, n INT").write.parquet(f"{log}/batch={batch}")
    want = [("a", 2), ("b", 1), ("c", 5)]
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == want
    assert runs.fold_state(spark, log, ["k"]) == 2
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == want
    assert [r["batch"] for r in spark.read.parquet(log).select("batch").distinct().collect()] == [2]
    spark.createDataFrame([("a", 3)], "k STRING, n INT").write.parquet(f"{log}/batch=3")
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == [("a", 3), ("b", 1), ("c", 5)]


@pytest.mark.parametrize("size,slide", [("10 minutes", "5 minutes"), ("10 minutes", "4 minutes"), ("1 hour", "1 minute"), ("1 day", None)])
def test_window_counts_equal_one_step_counts(spark, size, slide):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 61).cast("timestamp_ntz").alias("ts"))
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    want = df.groupBy(w.alias("w"), "k").count().select(F.col("w.start").alias("s"), "k", F.col("count").alias("n"))
    got = windows.window_counts(df, "ts", ["k"], size, slide)
    assert rows(got, "window_start", "k", "n") == rows(want, "s", "k", "n")


def test_dedup_keeps_one_of_many_copies(spark, arrivals, tmp_path):
    path = arrivals(*[("a", at(i % 7), 1 if i % 3 else i) for i in range(60)])
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema)
    _, out = run(spark, windows.dedup_stream(stream, ["i"], "ts", "10 minutes"), tmp_path)
    got = spark.read.parquet(out)
    assert got.count() == got.select("i").distinct().count() == 21


def test_custom_sessions_equal_the_built_in(spark, arrivals, tmp_path):
    data = [("a", at(m), m) for m in (0, 3, 4, 20, 24, 60)] + [("b", at(m), m) for m in (1, 2, 90)]
    path = arrivals(*data)
    schema = spark.read.parquet(path).schema
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER):
        _, mine = run(spark, state.custom_sessions(runs.table_stream(spark, path, schema), "k", "ts", 600, "5 minutes"), tmp_path, name="mine")
    _, builtin = run(spark, windows.session_counts_stream(runs.table_stream(spark, path, schema), "k", "ts", "10 minutes", "5 minutes"), tmp_path, name="builtin")
    cols = ["k", "session_start", "session_end", "n"]
    got = rows(spark.read.parquet(mine), *cols)
    assert got == rows(spark.read.parquet(builtin), *cols) and len(got) == 4


def test_spans_merge_across_batches():
    assert state.merge_spans([(10, 20, 1), (0, 10, 2), (15, 30, 3), (40, 50, 1)]) == [(0, 10, 2), (10, 30, 4), (40, 50, 1)]


def test_stream_stream_join_equals_the_batch_join(spark, arrivals, tmp_path):
    path = arrivals(*[("ab"[i % 2], at(i * 3), i) for i in range(60)])
    schema = spark.read.parquet(path).schema

    def sides(df):
        a = df.filter("i % 3 = 0").select("k", F.col("i").alias("ai"), F.col("ts").alias("at"))
        b = df.filter("i % 3 <> 0").select("k", F.col("i").alias("bi"), F.col("ts").alias("bt"))
        return a, b

    a, b = sides(runs.table_stream(spark, path, schema))[0], sides(runs.table_stream(spark, path, schema))[1]
    _, out = run(spark, windows.interval_join_streams(a, b, "k", "at", "bt", 600, "10 minutes").select("ai", "bi"), tmp_path)
    want = interval_join(*sides(spark.read.parquet(path)), "k", "at", "bt", 0, 600)
    got = rows(spark.read.parquet(out), "ai", "bi")
    assert got == rows(want, "ai", "bi") and got


def test_triggers_and_kafka_options(spark):
    assert runs.trigger_options() == {"availableNow": True}
    assert runs.trigger_options("10 seconds") == {"processingTime": "10 seconds"}
    assert runs.trigger_options(continuous="1 second") == {"continuous": "1 second"}
    # The connector jar is absent here; the options are built before it is looked up.
    with pytest.raises(Exception, match="kafka"):
        topics.read_topic(spark, "broker:9092", "clicks", True, max_per_trigger=1000)


def until(condition, seconds=60):
    end = time.monotonic() + seconds
    while not condition() and time.monotonic() < end:
        time.sleep(0.2)
    assert condition()


def test_one_plan_feeds_parquet_and_console(spark, arrivals, tmp_path):
    path = arrivals(("a", at(1), 1), ("a", at(2), 2), ("b", at(3), 3), ("a", at(50), 4))
    counts = windows.window_counts(runs.table_stream(spark, path, spark.read.parquet(path).schema), "ts", ["k"], "10 minutes", None, "10 minutes")
    out, cp = str(tmp_path / "both"), str(tmp_path / "cp-both")
    queries = runs.to_parquet_and_console(counts, out, cp)
    for q in queries:
        runs.finish(q)
        assert sum(p["numInputRows"] for p in q.recentProgress) == 4
    assert rows(spark.read.parquet(out), "k", "n") == [("a", 2), ("b", 1)]  # the window at 50 minutes is open
    assert "Console" in queries[1].recentProgress[0]["sink"]["description"]
    assert max(p["sink"]["numOutputRows"] for p in queries[1].recentProgress) == 3  # and printed


def test_continuous_trigger_reaches_sinks(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 20).option("numPartitions", 2).load()
    doubled = rate.filter("value % 2 = 0").select((F.col("value") * 2).alias("v"))
    query = runs.to_memory(doubled, "continuous_rows", str(tmp_path / "cp-mem"), continuous="1 second")
    until(lambda: spark.table("continuous_rows").count() >= 10)
    query.stop()
    got = {r["v"] for r in spark.table("continuous_rows").collect()}
    assert {0, 4, 8} <= got and all(v % 4 == 0 for v in got)
    query = runs.to_console(doubled, str(tmp_path / "cp-con"), mode="append", continuous="1 second")
    until(lambda: (tmp_path / "cp-con" / "commits" / "0").exists())
    assert query.exception() is None
    query.stop()


def test_state_lives_in_rocksdb_by_default(spark):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER


def test_files_per_trigger_limit(spark, arrivals, tmp_path):
    for m in range(3):
        path = arrivals(("a", at(m), m))
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    query, out = run(spark, stream, tmp_path, "update")
    assert spark.read.parquet(out).select("batch").distinct().count() == 3


def test_hourly_ingest_replaces_a_repeated_batch(spark, arrivals, tmp_path):
    path = arrivals(("a", at(0), 1), ("b", at(61), 2))
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema).withColumn(
        "timestamp_ms", F.unix_millis(F.col("ts").cast("timestamp")))
    out = str(tmp_path / "hours")
    for n in range(2):  # a lost checkpoint replays batch 0 into the same directory
        runs.finish(runs.hourly_ingest(stream, "timestamp_ms", out, str(tmp_path / f"cp{n}"), default_ms=None, every=None))
    assert spark.read.parquet(out).count() == 2


def test_late_rows_of_more_batches_than_a_query_remembers(spark, arrivals, tmp_path):
    with settings(spark, spark__sql__streaming__numRecentProgressUpdates="5"):
        for m in (0, 500, *([1] * 10)):
            path = arrivals(("a", at(m), m))
            stream = runs.table_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
        query = start(spark, windows.window_counts(stream, "ts", ["k"], "10 minutes", None, "10 minutes"), tmp_path)
        # Late rows are judged by the watermark of the batch before, so the first one still counts.
        assert runs.dropped_late(query, every=0.02) == 9


def test_custom_sessions_keep_a_null_key(spark, arrivals, tmp_path):
    path = arrivals((None, at(0), 1), ("a", at(1), 2), (None, at(2), 3))
    arrivals(("a", at(300), 4))
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER):
        _, out = run(spark, state.custom_sessions(stream, "k", "ts", 1800, "10 minutes"), tmp_path)
    assert sorted((r["k"] or "", r["n"]) for r in spark.read.parquet(out).collect()) == [("", 2), ("a", 1)]


def test_stream_join_has_a_lower_bound(spark, arrivals, tmp_path):
    path = arrivals(*[("a", at(m), m) for m in (0, 5, 20, 40)])
    schema = spark.read.parquet(path).schema
    a = runs.table_stream(spark, path, schema).select("k", F.col("ts").alias("a_ts"), F.col("i").alias("x"))
    b = runs.table_stream(spark, path, schema).select("k", F.col("ts").alias("b_ts"), F.col("i").alias("y"))
    pairs = windows.interval_join_streams(a, b, "k", "a_ts", "b_ts", 1200, "1 hour", lo_seconds=-360)
    _, out = run(spark, pairs.select("x", "y"), tmp_path)
    assert rows(spark.read.parquet(out), "x", "y") == [
        (x, y) for x in (0, 5, 20, 40) for y in (0, 5, 20, 40) if -6 <= y - x <= 20]


def test_fraud_rule_runs_on_a_stream(spark, arrivals, tmp_path):
    path = arrivals(*[("a", at(m), m) for m in (1, 2, 3)])
    arrivals(("a", at(9000), 0))
    stream = runs.table_stream(spark, path, spark.read.parquet(path).schema).select(
        "ts", F.lit(7).alias("user_id"), F.lit("purchase").alias("event_type"), (F.col("i") * 50.0).alias("value"))
    customers = spark.createDataFrame([(7, "x")], "c_custkey INT, c_mktsegment STRING")
    _, out = run(spark, windows.fraud_alerts(stream, customers, "ts", "1 day", 120.0, "10 minutes"), tmp_path)
    assert [(r["user_id"], r["n"], r["spent"]) for r in spark.read.parquet(out).collect()] == [(7, 3, 300.0)]


def test_a_fold_that_fails_loses_no_key(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    for n, data in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)]]):
        spark.createDataFrame(data, "k string, n int").write.parquet(f"{log}/batch={n}")
    want = [("a", 2), ("b", 1), ("c", 3)]

    def fail(*_):
        raise OSError("stopped")
    with monkeypatch.context() as patch:  # between publishing the fold and deleting what it covers
        patch.setattr(runs, "_drop", fail)
        with pytest.raises(OSError):
            runs.fold_state(spark, log, ["k"])
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == want
    assert runs.fold_state(spark, log, ["k"]) == 2
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == want
    spark.createDataFrame([("b", 9)], "k string, n int").write.parquet(f"{log}/batch=3")
    assert runs.fold_state(spark, log, ["k"]) == 3
    assert rows(runs.latest_state(spark, log, ["k"]), "k", "n") == [("a", 2), ("b", 9), ("c", 3)]
