"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import write_through


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``(a, b)``; the root is the component's smallest node.

    A large-star step links each node's larger neighbours to the smallest node it
    sees, a small-star step its smaller ones; both keep components whole and halve
    path lengths.  Every round is written to the shared folder and ends when an
    order-free digest of the edges stays the same.  A hub's neighbours stay rows:
    only its minimum is aggregated and joined back, which AQE splits.
    """
    now = write_through(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == seen:
            break
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = write_through(small.filter("a <> b").distinct(), "cc")
    # At the end every node but the roots points to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
