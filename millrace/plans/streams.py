"""Registered streaming queries; each runs to the end of its input and reads its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.operators import joins
from millrace.plans.registry import query
from millrace.session import ROCKSDB_PROVIDER, scratch_path, settings
from millrace.streaming import runs, state, windows
from millrace.sources import sinks, topics
from millrace.tables import load, path_of


def _stream(spark, sf):
    """The events as a stream, a few files of the table at a time."""
    return runs.table_stream(spark, path_of(sf, "events"), load(spark, sf, "events").schema, max_files=4)


def _slide(size: int, slide: int) -> str:
    ks = ", ".join(str(k) for k in range(size // slide))
    return f"""
    SELECT window_start, window_start + INTERVAL {size} MINUTE AS window_end, event_type, count(*) AS n FROM (
      SELECT time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {slide} MINUTE * k AS window_start, event_type
      FROM events, (SELECT unnest([{ks}]) AS k)) GROUP BY ALL
    """


@query("window_sliding", _slide(10, 5))
def window_sliding(spark, sf):
    return windows.window_counts(load(spark, sf, "events", "ts", "event_type"), "ts", ["event_type"], "10 minutes", "5 minutes")


@query("window_tumbling", _slide(60, 60))
def window_tumbling(spark, sf):
    return windows.window_counts(load(spark, sf, "events", "ts", "event_type"), "ts", ["event_type"], "1 hour")


@query("window_hop", _slide(5, 1))
def window_hop(spark, sf):
    return windows.window_counts(load(spark, sf, "events", "ts", "event_type"), "ts", ["event_type"], "5 minutes", "1 minute")


EMITTED = f"SELECT * FROM ({_slide(10, 5)}) WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query("window_append_emitted", EMITTED)
def window_append_emitted(spark, sf):
    events = load(spark, sf, "events", "ts", "event_type")
    return windows.emitted_windows(events, "ts", ["event_type"], "10 minutes", "5 minutes", "10 minutes")


@query("stream_window_append", EMITTED)
def stream_window_append(spark, sf):
    counts = windows.window_counts(_stream(spark, sf), "ts", ["event_type"], "10 minutes", "5 minutes", "10 minutes")
    path = scratch_path(spark, "windows")
    runs.finish(runs.to_parquet(counts, path, scratch_path(spark, "cp")))
    return spark.read.parquet(path)


@query("stream_source_json", "SELECT event_id, user_id, event_type FROM events")
def stream_source_json(spark, sf):
    body = F.to_json(F.struct("event_id", "user_id", "event_type"))
    topic = topics.as_topic(
        _stream(spark, sf), "clicks", F.col("user_id"), F.encode(body, "UTF-8"), F.col("event_id"), F.col("ts"), 4
    )
    rows = runs.parse_values(topic, "event_id BIGINT, user_id BIGINT, event_type STRING")
    path = scratch_path(spark, "parsed")
    runs.finish(runs.to_parquet(rows, path, scratch_path(spark, "cp")))
    return spark.read.parquet(path)


def _landing(spark, events, *parts):
    """Write the parts of a table into one landing folder, one run of a stream after each."""
    path = scratch_path(spark, "landing")
    for part in parts:
        events.filter(part).write.mode("append").parquet(path)
        yield path


@query("late_data_report", """
    WITH w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS n
               FROM events WHERE ts >= TIMESTAMP '2024-01-10' OR event_id % 2 = 0 GROUP BY ALL)
    SELECT sum(n)::BIGINT AS kept, count(*) AS n_windows, true AS late_dropped FROM w
    WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def late_data_report(spark, sf):
    """Three arrivals: early rows, newer rows that move the watermark, rows far too late."""
    events = load(spark, sf, "events", "event_id", "ts", "event_type")
    sink, cp = scratch_path(spark, "late-out"), scratch_path(spark, "cp")
    dropped = []
    arrivals = ["event_id % 2 = 0 AND ts < TIMESTAMP_NTZ'2024-01-10'", "ts >= TIMESTAMP_NTZ'2024-01-10'",
                "event_id % 2 = 1 AND ts < TIMESTAMP_NTZ'2024-01-10'"]
    for path in _landing(spark, events, *arrivals):
        stream = runs.table_stream(spark, path, events.schema)
        counts = windows.window_counts(stream, "ts", ["event_type"], "10 minutes", None, "10 minutes")
        dropped.append(runs.dropped_late(runs.to_parquet(counts, sink, cp)))
    kept = spark.read.parquet(sink).agg(F.sum("n").alias("kept"), F.count("*").alias("n_windows"))
    return kept.withColumn("late_dropped", F.lit(dropped[:2] == [0, 0] and dropped[2] > 0))


@query("stream_modes", f"""
    WITH w AS ({_slide(60, 60)})
    SELECT 'append' AS mode, count(*) AS n_rows FROM w WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
    UNION ALL SELECT unnest(['update', 'complete']), count(*) FROM w
""")
def stream_modes(spark, sf):
    """The same counts in each output mode, reported as rows a reader finds at the end:
    all of append mode, the newest per key of update mode, the last batch of complete mode."""
    reports = []
    for mode in ("append", "update", "complete"):
        counts = windows.window_counts(_stream(spark, sf), "ts", ["event_type"], "1 hour", None, "10 minutes")
        path = scratch_path(spark, f"mode-{mode}")
        runs.finish(runs.to_batches(counts, path, scratch_path(spark, "cp"), mode))
        out = spark.read.option("basePath", path).parquet(path)
        if mode == "update":
            out = runs.latest_state(spark, path, ["window_start", "window_end", "event_type"])
        elif mode == "complete":
            out = out.filter(F.col("batch") == out.agg(F.max("batch")).first()[0])
        reports.append(out.agg(F.count("*").alias("n_rows")).withColumn("mode", F.lit(mode)))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("stream_restart_exactly_once", "SELECT event_id, user_id, event_type, value FROM events")
def stream_restart_exactly_once(spark, sf):
    events = load(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    sink, cp = scratch_path(spark, "restart-out"), scratch_path(spark, "cp")
    for path in _landing(spark, events, "event_id % 2 = 0", "event_id % 2 = 1"):
        runs.finish(runs.to_parquet(runs.table_stream(spark, path, events.schema), sink, cp))
    return spark.read.parquet(sink)


@query("stream_dedup", "SELECT event_id, ts, user_id FROM events")
def stream_dedup(spark, sf):
    events = _stream(spark, sf).select("event_id", "ts", "user_id")
    copies = events.withColumn("_copy", F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0))))).drop("_copy")
    unique = windows.dedup_stream(copies, ["event_id"], "ts", "10 minutes")
    path = scratch_path(spark, "unique")
    runs.finish(runs.to_parquet(unique, path, scratch_path(spark, "cp")))
    return spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


SESSIONS = """
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {gap} SECOND AS session_end, count(*) AS n FROM (
      SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
        SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL {gap} SECOND
               THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s
"""


@query("sessionize", SESSIONS.format(gap=1800))
def sessionize(spark, sf):
    return windows.sessionize(load(spark, sf, "events", "user_id", "ts", "event_id"), "user_id", "ts", "event_id", 1800)


@query("stream_sessions", "SELECT * FROM (" + SESSIONS.format(gap=1800) + """)
    WHERE session_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def stream_sessions(spark, sf):
    with settings(spark, spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition="true"):
        sessions = windows.session_counts_stream(_stream(spark, sf), "user_id", "ts", "30 minutes", "10 minutes")
        path = scratch_path(spark, "sessions")
        runs.finish(runs.to_parquet(sessions, path, scratch_path(spark, "cp")))
    return spark.read.parquet(path)


@query("stream_sessions_custom", "SELECT * FROM (" + SESSIONS.format(gap=1800) + """)
    WHERE session_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def stream_sessions_custom(spark, sf):
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER):
        sessions = state.custom_sessions(_stream(spark, sf), "user_id", "ts", 1800, "10 minutes")
        path = scratch_path(spark, "sessions")
        runs.finish(runs.to_parquet(sessions, path, scratch_path(spark, "cp")))
    return spark.read.parquet(path)


@query("stream_upsert_sink", _slide(60, 60))
def stream_upsert_sink(spark, sf):
    events = load(spark, sf, "events", "event_id", "ts", "event_type")
    log, cp = scratch_path(spark, "upserts"), scratch_path(spark, "cp")
    for path in _landing(spark, events, "event_id % 2 = 0", "event_id % 2 = 1"):
        stream = runs.table_stream(spark, path, events.schema)
        counts = windows.window_counts(stream, "ts", ["event_type"], "1 hour", None, "60 days")
        runs.finish(runs.to_batches(counts, log, cp))
    return runs.latest_state(spark, log, ["window_start", "window_end", "event_type"])


@query("stream_hourly_ingest", """
    SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
           strftime(ts, '%H') AS hour, count(*) AS n FROM events GROUP BY ALL
""")
def stream_hourly_ingest(spark, sf):
    events = _stream(spark, sf).withColumn("timestamp_ms", scalars.utc_millis(F.col("ts")))
    path = scratch_path(spark, "ingest")
    runs.finish(runs.hourly_ingest(events, "timestamp_ms", path, scratch_path(spark, "cp"), default_ms=None, every=None))
    return sinks.read_hourly(spark, path).groupBy(*sinks.HOUR).agg(F.count("*").alias("n"))


@query("stream_static_join", """
    SELECT event_id, user_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey
""")
def stream_static_join(spark, sf):
    customers = load(spark, sf, "customer", "c_custkey", "c_mktsegment").withColumnRenamed("c_custkey", "user_id")
    events = _stream(spark, sf).select("event_id", "user_id")
    path = scratch_path(spark, "enriched")
    runs.finish(runs.enrich(events, customers, "user_id", path, scratch_path(spark, "cp")))
    return spark.read.parquet(path).drop("batch")


PAIRS = """
    SELECT v.user_id, v.event_id AS view_id, p.event_id AS purchase_id FROM events v JOIN events p
    ON v.user_id = p.user_id AND v.event_type = 'view' AND p.event_type = 'purchase'
    AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 10 MINUTE
"""


def _views_purchases(df):
    views = df.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    bought = df.filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return views, bought


@query("interval_join", PAIRS)
def interval_join(spark, sf):
    views, bought = _views_purchases(load(spark, sf, "events", "event_id", "user_id", "event_type", "ts"))
    pairs = joins.interval_join(views, bought, "user_id", "view_ts", "purchase_ts", 0, 600)
    return pairs.select("user_id", "view_id", "purchase_id")


@query("stream_stream_join", PAIRS)
def stream_stream_join(spark, sf):
    views, _ = _views_purchases(_stream(spark, sf))
    _, bought = _views_purchases(_stream(spark, sf))
    pairs = windows.interval_join_streams(views, bought, "user_id", "view_ts", "purchase_ts", 600, "10 minutes")
    path = scratch_path(spark, "pairs")
    runs.finish(runs.to_parquet(pairs.select("user_id", "view_id", "purchase_id"), path, scratch_path(spark, "cp")))
    return spark.read.parquet(path)


@query("fraud_rule_alerts", """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, user_id, c_mktsegment, count(*) AS n, round(sum(value), 2) AS spent
    FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase'
    GROUP BY ALL HAVING sum(value) > 120
""")
def fraud_rule_alerts(spark, sf):
    out = windows.fraud_alerts(
        load(spark, sf, "events", "ts", "user_id", "event_type", "value"),
        load(spark, sf, "customer", "c_custkey", "c_mktsegment"), "ts", "1 day", 120.0,
    )
    return out.withColumn("spent", F.round("spent", 2))
