"""Arithmetic on log offsets: counts, lag, commits and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = ["topic", "partition"]


def partition_counts(log: DataFrame) -> DataFrame:
    """Earliest and end offset of each partition and the messages between them."""
    return log.groupBy(*PART).agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("end")
    ).withColumn("n_messages", F.col("end") - F.col("earliest"))


def consumer_lag(ends: DataFrame, commits: DataFrame, groups: list[str]) -> DataFrame:
    """Messages each group has still to read per topic.

    A partition the group never committed counts from its earliest offset.
    """
    expected = ends.withColumn("group", F.explode(F.array(*[F.lit(g) for g in groups])))
    joined = expected.join(commits, ["group", *PART], "left")
    behind = F.col("end") - F.coalesce("committed", "earliest")
    return joined.groupBy("group", "topic").agg(F.sum(behind).alias("lag"))


def offsets_to_commit(log: DataFrame, ok: Column | None = None) -> DataFrame:
    """Next offset per partition: after the last row, or the last good one when ``ok`` is given."""
    rows = log if ok is None else log.filter(ok)
    return rows.groupBy(*PART).agg((F.max("offset") + 1).alias("committed"))


def replay_from(log: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows from the first offset at or after ``start`` on, per partition."""
    first = log.filter(F.col(ts) >= start).groupBy(*PART).agg(F.min("offset").alias("_first"))
    return log.join(first, PART).filter("offset >= _first").drop("_first")
