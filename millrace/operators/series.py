"""Pi, summed or sampled over the ids of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pi_leibniz(ids: DataFrame, id_col: str) -> DataFrame:
    """The alternating series over ids 0..n-1, one term per row."""
    i = F.col(id_col)
    term = F.when(i % 2 == 0, 1.0).otherwise(-1.0) / (2 * i + 1)
    return ids.agg((4 * F.sum(term)).alias("pi"))


def pi_sampling(ids: DataFrame, id_col: str) -> DataFrame:
    """Share of evenly spread points inside the quarter circle."""
    # Powers of the inverse plastic number spread points evenly.
    x = (F.col(id_col) * F.lit(0.7548776662466927)) % 1
    y = (F.col(id_col) * F.lit(0.5698402909980532)) % 1
    inside = F.count(F.when(x * x + y * y <= 1, 1))
    return ids.agg(inside.alias("inside"), F.count("*").alias("n")).withColumn(
        "pi", 4 * F.col("inside") / F.col("n")
    )
