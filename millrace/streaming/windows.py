"""Event-time windows, sessions, deduplication and joins.

The same functions take a stream or a table: a watermark means nothing to a batch
query, and the emitted rows then are those of a stream that has ended, except where
a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import scalar
from millrace.operators.ordered import ordered, with_previous, with_running_sum


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Give ``ts`` the zoned type watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _seconds(interval: str) -> int | None:
    """Length of ``"<n> <unit>"`` in seconds, None for units without a fixed one."""
    number, unit = interval.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}
    size = sizes.get(unit.rstrip("s"))
    return int(number) * size if size else None


def window_counts(df: DataFrame, ts: str, keys: list[str], size: str, slide: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """Rows per window and key; partial counts are made before the shuffle.

    Overlapping windows of a table are added up from counts per slide, so that a
    row is not copied into every window it belongs to.  A stream keeps one step.
    """
    if delay:
        df = event_time(df, ts).withWatermark(ts, delay)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    whole, step = _seconds(size), _seconds(slide) if slide else None
    if not df.isStreaming and step and whole and whole > step and whole % step == 0:
        slots = df.groupBy(F.window(ts, slide)["start"].alias(ts), *keys).agg(F.count("*").alias("n"))
        counts = slots.groupBy(window.alias("w"), *keys).agg(F.sum("n").alias("n"))
    else:
        counts = df.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counts.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "n",
    )


def emitted_windows(df: DataFrame, ts: str, keys: list[str], size: str, slide: str | None,
                    delay: str) -> DataFrame:
    """What append mode has emitted once all of ``df`` is read: the closed windows."""
    watermark = scalar(df, F.max(ts)) - F.expr(f"INTERVAL {delay}")
    return window_counts(df, ts, keys, size, slide).filter(F.col("window_end") <= watermark)


def dedup_stream(df: DataFrame, ids: list[str], ts: str, delay: str) -> DataFrame:
    """First row of each id within the watermark."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(ids)


def session_counts_stream(df: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Sessions on a stream.  Set ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    so that a busy key is merged before the shuffle."""
    marked = event_time(df, ts).withWatermark(ts, delay)
    agg = marked.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return agg.select(
        key, F.col("w.start").cast("timestamp_ntz").alias("session_start"),
        F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n",
    )


def sessionize(df: DataFrame, key: str, ts: str, tie: str, gap_seconds: int) -> DataFrame:
    """Sessions of a table: a new one after a pause of ``gap_seconds`` or more.

    A key's rows are spread over ordered chunks, so one busy key is many tasks.
    """
    o = with_previous(ordered(df.select(key, ts, tie), [key], [ts, tie]), _before=ts)
    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    starts = F.col("_before").isNull() | (F.col(ts) >= F.col("_before") + gap)
    o = with_running_sum(o, "_session", starts.cast("bigint"))
    return o.rows().groupBy(key, "_session").agg(
        F.min(ts).alias("session_start"), (F.max(ts) + gap).alias("session_end"),
        F.count("*").alias("n"),
    ).drop("_session")


def interval_join_streams(a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str,
                          hi_seconds: int, delay: str, lo_seconds: int = 0) -> DataFrame:
    """Inner join of two streams, ``b_ts`` from ``lo_seconds`` to ``hi_seconds`` after ``a_ts``.

    Rows meet by key and time slot, so the state of one busy key is spread over
    its slots; the watermarks and the time condition let the state be dropped.
    """
    left = event_time(a, a_ts).withWatermark(a_ts, delay)
    right = event_time(b, b_ts).withWatermark(b_ts, delay).withColumnRenamed(key, "_key")
    slot = max(hi_seconds - lo_seconds, 1) * 1_000_000
    first = F.floor((F.unix_micros(a_ts) + lo_seconds * 1_000_000) / slot)
    left = left.withColumn("_slot", F.explode(F.array(first, first + 1)))
    right = right.withColumn("_slot_b", F.floor(F.unix_micros(b_ts) / slot))
    cond = (
        (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_slot_b"))
        & (F.col(b_ts) >= F.col(a_ts) + F.expr(f"INTERVAL {lo_seconds} SECONDS"))
        & (F.col(b_ts) <= F.col(a_ts) + F.expr(f"INTERVAL {hi_seconds} SECONDS"))
    )
    return left.join(right, cond).drop("_slot", "_slot_b", "_key")


def fraud_alerts(events: DataFrame, customers: DataFrame, ts: str, size: str,
                 limit: float, delay: str | None = None) -> DataFrame:
    """Purchase sums per user and window above ``limit``, with the user's segment.

    Sums come before the join, so a busy user reaches it as one row per window.
    """
    if delay:
        events = event_time(events, ts).withWatermark(ts, delay)
    sums = events.filter("event_type = 'purchase'").groupBy(F.window(ts, size).alias("w"), "user_id").agg(
        F.count("*").alias("n"), F.sum("value").alias("spent")
    )
    joined = sums.filter(F.col("spent") > limit).join(customers, F.expr("user_id = c_custkey"))
    return joined.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), "user_id", "c_mktsegment", "n", "spent"
    )
