"""Order, distribution, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import scalar


def top_groups(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` largest groups; ties go by key."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(k)
    )


def latest(df: DataFrame, ts: str, tie: str, n: int) -> DataFrame:
    """The ``n`` newest rows."""
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def cluster_by(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Distribute by ``keys`` and sort inside each partition."""
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def distribute_by(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    return df.repartition(partitions, *keys)


def sort_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.sortWithinPartitions(*keys)


def fewer_partitions(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle."""
    return df.coalesce(n)


def bucket_sample(df: DataFrame, key: str, bucket: int, of: int) -> DataFrame:
    """Rows of one bucket out of ``of`` (1-based) by key value: the same rows each time."""
    return df.filter(F.pmod(F.col(key), F.lit(of)) == bucket - 1)


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; columns a frame lacks are NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def hybrid(offline: DataFrame, realtime: DataFrame, ts: str) -> DataFrame:
    """Offline rows, and realtime rows after the newest offline one."""
    boundary = scalar(offline, F.max(ts))
    later = F.coalesce(F.col(ts) > boundary, boundary.isNull())
    return offline.unionByName(realtime.filter(later))


def tagged_feeds(feeds: dict[str, DataFrame], tag: str) -> DataFrame:
    """One table from several feeds, each row tagged with its feed's name."""
    return union_all(*[df.withColumn(tag, F.lit(name)) for name, df in feeds.items()])
