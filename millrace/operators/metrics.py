"""Time-series operators over a samples table.

A series is named by plain columns.  Per-series steps go through the ordered
chunks, so a series that holds most samples is spread over many tasks.  Rates
are the corrected increase over the span between first and last sample in the
window; they are not extrapolated to the window's edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import (
    exact_quantiles, ordered, with_previous, with_running_max,
)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fraction, from whole microseconds: epoch doubles would lose digits."""
    return (
        F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    ) / F.lit(1_000_000)


def series_key(labels: Column) -> Column:
    """Label map as text that is equal for equal labels."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def drop_labels(labels: Column, names: list[str]) -> Column:
    """The label map without volatile labels."""
    return F.map_filter(labels, lambda k, v: ~k.isin(names))


def _in_windows(samples: DataFrame, ts: str, window: str) -> DataFrame:
    return samples.withColumn("window_start", F.window(ts, window)["start"])


def _deltas(samples: DataFrame, series: list[str], ts: str, tie: str, value: str, window: str) -> DataFrame:
    """Step from the sample before in the same window; after a reset the value itself."""
    rows = _in_windows(samples.filter(F.col(value).isNotNull()), ts, window)
    rows = rows.select(*series, "window_start", ts, tie, value)
    o = ordered(rows, [*series, "window_start"], [ts, tie])
    rows = with_previous(o, _prev_value=value, _prev_ts=ts).rows()
    step = F.when(F.col(value) < F.col("_prev_value"), F.col(value)).otherwise(
        F.col(value) - F.col("_prev_value")
    )
    return rows.withColumn("_step", F.when(F.col("_prev_value").isNotNull(), step))


def increase(samples: DataFrame, series: list[str], ts: str, tie: str, value: str, window: str) -> DataFrame:
    """Counter increase and per-second rate per series and window of two samples or more."""
    rows = _deltas(samples, series, ts, tie, value, window)
    agg = rows.groupBy(*series, "window_start").agg(
        F.sum("_step").alias("increase"), F.count("*").alias("n_samples"),
        seconds_between(F.min(ts), F.max(ts)).alias("_span"),
    ).filter("n_samples >= 2")
    rate = F.when(F.col("_span") > 0, F.col("increase") / F.col("_span"))
    return agg.withColumn("rate", rate).drop("_span")


def range_rate(samples: DataFrame, series: list[str], ts: str, tie: str, value: str, span: str, step: str) -> DataFrame:
    """Increase and per-second rate over the trailing ``span`` at every ``step``: ``window_end`` is its end.

    Steps between neighbours are worked out once per series and added up per slide of
    ``step``, and only slides are copied into the windows they belong to.  A window's
    increase leaves out the step that led to its first sample.
    """
    rows = samples.filter(F.col(value).isNotNull()).select(*series, ts, tie, value)
    rows = with_previous(ordered(rows, series, [ts, tie]), _prev_value=value).rows()
    delta = F.when(F.col(value) < F.col("_prev_value"), F.col(value)).otherwise(F.col(value) - F.col("_prev_value"))
    rows = rows.withColumn("_step", F.coalesce(delta, F.lit(0.0)))
    slides = rows.groupBy(*series, F.window(ts, step)["start"].alias("_slide")).agg(
        F.sum("_step").alias("_sum"), F.min(F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"), "_step")).alias("_first"),
        F.max(ts).alias("_last"), F.count("*").alias("_n"))
    agg = slides.groupBy(*series, F.window("_slide", span, step)["end"].alias("window_end")).agg(
        (F.sum("_sum") - F.min("_first")["_step"]).alias("increase"), F.sum("_n").alias("n_samples"),
        seconds_between(F.min("_first")["ts"], F.max("_last")).alias("_span")).filter("n_samples >= 2")
    rate = F.when(F.col("_span") > 0, F.col("increase") / F.col("_span"))
    return agg.withColumn("rate", rate).drop("_span")


def instant_rate(samples: DataFrame, series: list[str], ts: str, tie: str, value: str, window: str) -> DataFrame:
    """Per-second rate of the last two samples per series and window."""
    rows = _deltas(samples, series, ts, tie, value, window)
    last = rows.groupBy(*series, "window_start").agg(
        F.max_by(
            F.struct("_step", seconds_between(F.col("_prev_ts"), F.col(ts)).alias("_span")),
            F.struct(ts, tie),
        ).alias("_last")
    ).filter("_last._step IS NOT NULL")
    return last.select(
        *series, "window_start", (F.col("_last._step") / F.col("_last._span")).alias("irate")
    )


def predict_linear(samples: DataFrame, series: list[str], ts: str, value: str, window: str,
                   horizon_seconds: int) -> DataFrame:
    """Least-squares forecast ``horizon_seconds`` after the newest sample of each window."""
    rows = _in_windows(samples, ts, window)
    x = seconds_between(F.col("window_start"), F.col(ts))
    rows = rows.withColumn("_x", x)
    fit = rows.groupBy(*series, "window_start").agg(
        F.regr_slope(value, "_x").alias("_slope"), F.regr_intercept(value, "_x").alias("_icept"),
        F.max("_x").alias("_last"), F.count("*").alias("n_samples"),
    ).filter("n_samples >= 2")
    forecast = F.col("_icept") + F.col("_slope") * (F.col("_last") + horizon_seconds)
    return fit.select(*series, "window_start", "n_samples", forecast.alias("predicted"))


def cumulative_buckets(samples: DataFrame, by: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative counts per upper bound ``le`` (infinity last), counted in one pass."""
    les = [*bounds, float("inf")]
    counts = samples.groupBy(*by).agg(
        *[F.count(F.when(F.col(value) <= le, 1)).alias(f"_b{i}") for i, le in enumerate(les)]
    )
    cells = F.array(*[
        F.struct(F.lit(le).alias("le"), F.col(f"_b{i}").alias("n")) for i, le in enumerate(les)
    ])
    return counts.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.le", "_c.n")


def histogram_quantile(buckets: DataFrame, by: list[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets ``le, n``, linear inside the bucket.

    Counts of equal (group, le) are added first; what is left per group is one row
    per bound, a fixed and short list.
    """
    sums = buckets.groupBy(*by, "le").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by).orderBy("le")
    rows = sums.select(
        *by, "le", "n",
        F.coalesce(F.lag("n").over(w), F.lit(0)).alias("_below"),
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("_from"),
        F.max("n").over(Window.partitionBy(*by)).alias("_total"),
    )
    rank = F.lit(q) * F.col("_total")
    hit = rows.filter((F.col("_total") > 0) & (F.col("n") >= rank) & ((F.col("_below") < rank) | (F.col("n") == F.col("_below"))))
    first = hit.groupBy(*by).agg(F.min_by(F.struct("le", "n", "_below", "_from", "_total"), "le").alias("h"))
    le, lo = F.col("h.le"), F.col("h._from")
    inside = lo + (le - lo) * (F.lit(q) * F.col("h._total") - F.col("h._below")) / (F.col("h.n") - F.col("h._below"))
    value = F.when(le == F.lit(float("inf")), lo).when(F.col("h.n") == F.col("h._below"), lo).otherwise(inside)
    return first.select(*by, value.alias("quantile"))


def sum_by(samples: DataFrame, labels: str, names: list[str], value: str) -> DataFrame:
    """Sum, mean and count over the given labels of the label map."""
    keys = [F.element_at(F.col(labels), F.lit(n)).alias(n) for n in names]
    return samples.groupBy(*keys).agg(
        F.sum(value).alias("sum"), F.avg(value).alias("avg"), F.count("*").alias("n")
    )


def ratio_percent(numerator: DataFrame, denominator: DataFrame, on: list[str]) -> DataFrame:
    """100 x value ratio of two series matched on labels and time, one row each per match."""
    a = numerator.select(*on, F.col("value").alias("_a"))
    b = denominator.select(*on, F.col("value").alias("_b"))
    return a.join(b, on).select(
        *on, F.when(F.col("_b") != 0, 100 * F.col("_a") / F.col("_b")).alias("percent")
    )


def alerts(samples: DataFrame, series: list[str], ts: str, condition: Column,
           hold_seconds: int, step_seconds: int) -> DataFrame:
    """State of an alert at each sample that meets ``condition``.

    Samples in a row that meet it form a stretch; it is pending until it has held
    ``hold_seconds`` and firing from then on.  A sample that does not meet it, or a gap above
    ``step_seconds``, ends the stretch.
    """
    rows = samples.withColumn("_bad", F.coalesce(condition, F.lit(False)))
    o = with_previous(ordered(rows, series, [ts]), _prev_ts=ts, _prev_bad="_bad")
    gap = seconds_between(F.col("_prev_ts"), F.col(ts))
    starts = F.col("_bad") & (
        F.col("_prev_ts").isNull() | ~F.col("_prev_bad") | (gap > step_seconds)
    )
    o = with_running_max(o, "active_since", F.when(starts, F.col(ts)))
    held = seconds_between(F.col("active_since"), F.col(ts))
    return o.rows().filter("_bad").withColumn(
        "state", F.when(held >= hold_seconds, "firing").otherwise("pending")
    ).drop("_bad", "_prev_ts", "_prev_bad")


def cardinality(samples: DataFrame, metric: str, labels: str, k: int) -> DataFrame:
    """The ``k`` metrics with the most distinct label sets."""
    return samples.groupBy(metric).agg(
        F.count_distinct(series_key(F.col(labels))).alias("n_series")
    ).orderBy(F.desc("n_series"), metric).limit(k)


def slo(samples: DataFrame, by: list[str], good: Column, target: float) -> DataFrame:
    """Share of good samples, whether it meets the target, and the error budget left."""
    agg = samples.groupBy(*by).agg(
        F.count("*").alias("total"), F.count(F.when(good, 1)).alias("good")
    )
    sli = F.col("good") / F.col("total")
    return agg.withColumn("sli", sli).withColumn("met", sli >= target).withColumn(
        "budget_left", 1 - (1 - sli) / F.lit(1 - target)
    )


def latency_percentiles(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    return exact_quantiles(samples, by, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def absent_targets(expected: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Expected targets that reported nothing."""
    return expected.join(seen.select(*keys).distinct(), keys, "left_anti")
