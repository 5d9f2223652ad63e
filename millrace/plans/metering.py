"""Registered metric queries.  Counter: event_id modulo 1000, which resets as it grows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import metrics
from millrace.operators.ordered import ordered, with_running_sum
from millrace.plans.registry import query
from millrace.session import write_through
from millrace.tables import load

COUNTER = """
    WITH s AS (SELECT event_type, date_trunc('hour', ts) - INTERVAL 1 HOUR * (hour(ts) % 6) AS window_start, ts, event_id,
                      CAST(event_id % 1000 AS DOUBLE) AS v FROM events),
    l AS (SELECT *, lag(v) OVER w AS pv, lag(ts) OVER w AS pts FROM s
          WINDOW w AS (PARTITION BY event_type, window_start ORDER BY ts, event_id)),
    d AS (SELECT *, CASE WHEN pv IS NULL THEN NULL WHEN v < pv THEN v ELSE v - pv END AS step FROM l)
"""


def _counter(spark, sf):
    return load(spark, sf, "events", "event_id", "ts", "event_type").withColumn(
        "v", (F.col("event_id") % 1000).cast("double")
    )


@query("metric_increase", COUNTER + """
    SELECT event_type, window_start, round(sum(step), 4) AS increase, count(*) AS n_samples FROM d
    GROUP BY ALL HAVING count(*) >= 2
""")
def metric_increase(spark, sf):
    out = metrics.increase(_counter(spark, sf), ["event_type"], "ts", "event_id", "v", "6 hours")
    return out.select("event_type", "window_start", F.round("increase", 4).alias("increase"), "n_samples")


@query("metric_rate", COUNTER + """
    SELECT event_type, window_start,
           round(sum(step) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000), 6) AS rate
    FROM d GROUP BY ALL HAVING count(*) >= 2
""")
def metric_rate(spark, sf):
    out = metrics.increase(_counter(spark, sf), ["event_type"], "ts", "event_id", "v", "6 hours")
    return out.select("event_type", "window_start", F.round("rate", 6).alias("rate"))


@query("metric_range_rate", """
    WITH w AS (SELECT event_type, ts, event_id, CAST(event_id % 1000 AS DOUBLE) AS v,
                      time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR * k AS window_end
               FROM events, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS k)),
    l AS (SELECT *, lag(v) OVER (PARTITION BY event_type, window_end ORDER BY ts, event_id) AS pv FROM w),
    d AS (SELECT *, CASE WHEN pv IS NULL THEN NULL WHEN v < pv THEN v ELSE v - pv END AS step FROM l)
    SELECT event_type, window_end, count(*) AS n_samples, round(sum(step), 4) AS increase,
           round(CASE WHEN max(ts) > min(ts) THEN sum(step) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) END, 6) AS rate
    FROM d GROUP BY ALL HAVING count(*) >= 2
""")
def metric_range_rate(spark, sf):
    out = metrics.range_rate(_counter(spark, sf), ["event_type"], "ts", "event_id", "v", "6 hours", "1 hour")
    return out.select("event_type", "window_end", "n_samples", F.round("increase", 4).alias("increase"), F.round("rate", 6).alias("rate"))


BUCKET_RATE = """
    WITH le AS (SELECT unnest([25.0, 50.0, 100.0, 200.0, 400.0, 'Infinity'::DOUBLE]::DOUBLE[]) AS le),
    h AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, le, count(*) FILTER (WHERE value <= le) AS n FROM events, le GROUP BY ALL),
    c AS (SELECT event_type, hour, le, sum(n) OVER (PARTITION BY event_type, le ORDER BY hour) AS v FROM h),
    r AS (SELECT event_type, le, date_trunc('hour', hour) - INTERVAL 1 HOUR * (hour(hour) % 6) AS window_start,
                 (max(v) - min(v)) / (count(*) * 0 + epoch(max(hour)) - epoch(min(hour))) AS n, count(*) AS k
          FROM c GROUP BY ALL HAVING count(*) >= 2),
    w AS (SELECT *, coalesce(lag(n) OVER p, 0) AS below, coalesce(lag(le) OVER p, 0) AS lo,
                 max(n) OVER (PARTITION BY event_type, window_start) AS total
          FROM r WINDOW p AS (PARTITION BY event_type, window_start ORDER BY le)),
    f AS (SELECT *, row_number() OVER (PARTITION BY event_type, window_start ORDER BY le) AS rn FROM w
          WHERE total > 0 AND n >= 0.95::DOUBLE * total AND (below < 0.95::DOUBLE * total OR n = below))
    SELECT event_type, window_start, round(CASE WHEN isinf(le) OR n = below THEN lo
           ELSE lo + (le - lo) * (0.95::DOUBLE * total - below) / (n - below) END, 4) AS quantile
    FROM f WHERE rn = 1
"""


@query("metric_bucket_rate_quantile", BUCKET_RATE)
def metric_bucket_rate_quantile(spark, sf):
    """The 95th percentile from the rates of bucket counters read every hour, per six hours."""
    events = load(spark, sf, "events", "ts", "event_type", "value").withColumn("hour", F.window("ts", "1 hour")["start"])
    counts = metrics.cumulative_buckets(events, ["event_type", "hour"], "value", [25.0, 50.0, 100.0, 200.0, 400.0])
    counters = with_running_sum(ordered(write_through(counts, "buckets"), ["event_type", "le"], ["hour"]), "v", F.col("n")).rows()
    rates = metrics.increase(counters.withColumn("v", F.col("v").cast("double")), ["event_type", "le"], "hour", "n", "v", "6 hours")
    found = metrics.histogram_quantile(rates.select("event_type", "window_start", "le", F.col("rate").alias("n")), ["event_type", "window_start"], 0.95)
    return found.withColumn("quantile", F.round("quantile", 4))


@query("metric_irate", COUNTER + """
    SELECT event_type, window_start, arg_max(step / ((epoch_us(ts) - epoch_us(pts)) / 1000000), event_id) AS irate
    FROM d WHERE pv IS NOT NULL GROUP BY ALL
""")
def metric_irate(spark, sf):
    return metrics.instant_rate(_counter(spark, sf), ["event_type"], "ts", "event_id", "v", "6 hours")


@query("metric_predict_linear", """
    WITH s AS (SELECT event_type, date_trunc('hour', ts) - INTERVAL 1 HOUR * (hour(ts) % 4) AS window_start, ts, value FROM events),
    x AS (SELECT *, (epoch_us(ts) - epoch_us(window_start)) / 1000000 AS x FROM s)
    SELECT event_type, window_start, count(*) AS n_samples,
           round(regr_intercept(value, x) + regr_slope(value, x) * (max(x) + 3600), 3) AS predicted
    FROM x GROUP BY ALL HAVING count(*) >= 2
""")
def metric_predict_linear(spark, sf):
    gauge = load(spark, sf, "events", "ts", "event_type", "value")
    out = metrics.predict_linear(gauge, ["event_type"], "ts", "value", "4 hours", 3600)
    return out.withColumn("predicted", F.round("predicted", 3))


@query("metric_histogram_quantile", """
    WITH le AS (SELECT unnest([25.0, 50.0, 100.0, 200.0, 400.0, 'Infinity'::DOUBLE]::DOUBLE[]) AS le),
    b AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events, le GROUP BY ALL),
    w AS (SELECT *, coalesce(lag(n) OVER p, 0) AS below, coalesce(lag(le) OVER p, 0) AS lo,
                 max(n) OVER (PARTITION BY event_type) AS total
          FROM b WINDOW p AS (PARTITION BY event_type ORDER BY le)),
    h AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS rn FROM w
          WHERE n >= 0.95 * total AND below < 0.95 * total)
    SELECT event_type, round(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (0.95::DOUBLE * total - below) / (n - below) END, 6) AS quantile
    FROM h WHERE rn = 1
""")
def metric_histogram_quantile(spark, sf):
    events = load(spark, sf, "events", "event_type", "value")
    buckets = metrics.cumulative_buckets(events, ["event_type"], "value", [25.0, 50.0, 100.0, 200.0, 400.0])
    return metrics.histogram_quantile(buckets, ["event_type"], 0.95).withColumn("quantile", F.round("quantile", 6))


def _labelled(spark, sf):
    return load(spark, sf, "events", "event_id", "ts", "event_type", "user_id", "value").withColumn(
        "labels", F.create_map(
            F.lit("job"), F.col("event_type"), F.lit("instance"), (F.col("user_id") % 5).cast("string"),
            F.lit("request"), F.col("event_id").cast("string"),
        )
    )


@query("metric_sum_by", """
    SELECT event_type AS job, CAST(user_id % 5 AS VARCHAR) AS instance, round(sum(value), 2) AS sum,
           round(avg(value), 4) AS avg, count(*) AS n FROM events GROUP BY 1, 2
""")
def metric_sum_by(spark, sf):
    out = metrics.sum_by(_labelled(spark, sf), "labels", ["job", "instance"], "value")
    return out.withColumn("sum", F.round("sum", 2)).withColumn("avg", F.round("avg", 4))


@query("metric_ratio_percent", """
    SELECT day, instance, round(100 * (sum(value) FILTER (WHERE event_type = 'purchase')) / sum(value), 6) AS percent
    FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, user_id % 5 AS instance, event_type, value FROM events)
    GROUP BY day, instance HAVING count(*) FILTER (WHERE event_type = 'purchase') > 0
""")
def metric_ratio_percent(spark, sf):
    events = load(spark, sf, "events", "ts", "user_id", "event_type", "value").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("user_id") % 5).alias("instance"), "event_type", "value"
    )
    on = ["day", "instance"]
    total = events.groupBy(*on).agg(F.sum("value").alias("value"))
    sold = events.filter("event_type = 'purchase'").groupBy(*on).agg(F.sum("value").alias("value"))
    return metrics.ratio_percent(sold, total, on).withColumn("percent", F.round("percent", 6))


@query("alert_for_duration", """
    WITH s AS (SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2),
    f AS (SELECT *, lag(ts) OVER w AS pts, lag(n) OVER w AS pn FROM s WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
    g AS (SELECT *, sum(CASE WHEN n >= 3 AND (pts IS NULL OR pn < 3 OR ts - pts > INTERVAL 1 HOUR) THEN 1 ELSE 0 END)
                 OVER (PARTITION BY event_type ORDER BY ts) AS island FROM f),
    i AS (SELECT event_type, ts, n, min(ts) OVER (PARTITION BY event_type, island) AS active_since FROM g WHERE n >= 3)
    SELECT *, CASE WHEN ts - active_since >= INTERVAL 2 HOUR THEN 'firing' ELSE 'pending' END AS state FROM i
""")
def alert_for_duration(spark, sf):
    hourly = load(spark, sf, "events", "ts", "event_type").groupBy(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    ).agg(F.count("*").alias("n"))
    return metrics.alerts(hourly, ["event_type"], "ts", F.col("n") >= 3, 7200, 3600)


@query("metric_cardinality", """
    SELECT event_type AS metric, count(DISTINCT user_id % 5) AS n_series FROM events GROUP BY 1
    ORDER BY n_series DESC, metric LIMIT 10
""")
def metric_cardinality(spark, sf):
    samples = _labelled(spark, sf).select(
        F.col("event_type").alias("metric"), metrics.drop_labels(F.col("labels"), ["request"]).alias("labels")
    )
    return metrics.cardinality(samples, "metric", "labels", 10)


@query("slo_compliance", """
    SELECT event_type, count(*) AS total, count(*) FILTER (WHERE value < 150) AS good,
           round(count(*) FILTER (WHERE value < 150) / count(*), 6) AS sli,
           count(*) FILTER (WHERE value < 150) / count(*) >= 0.9 AS met,
           round(1 - (1 - count(*) FILTER (WHERE value < 150) / count(*)) / (1 - 0.9::DOUBLE), 4) AS budget_left
    FROM events GROUP BY event_type
""")
def slo_compliance(spark, sf):
    out = metrics.slo(load(spark, sf, "events", "event_type", "value"), ["event_type"], F.col("value") < 150, 0.9)
    return out.withColumn("sli", F.round("sli", 6)).withColumn("budget_left", F.round("budget_left", 4))


@query("latency_percentiles", """
    SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
           round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type
""")
def latency_percentiles(spark, sf):
    out = metrics.latency_percentiles(load(spark, sf, "events", "event_type", "value"), ["event_type"], "value")
    return out.select("event_type", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


@query("target_down", """
    SELECT c_custkey AS user_id FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type <> 'error')
""")
def target_down(spark, sf):
    expected = load(spark, sf, "customer", "c_custkey").select(F.col("c_custkey").alias("user_id"))
    seen = load(spark, sf, "events", "user_id", "event_type").filter("event_type <> 'error'")
    return metrics.absent_targets(expected, seen, ["user_id"])
