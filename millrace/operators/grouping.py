"""Aggregates: frequencies, cubes and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value occurs in each column, in one pass over the table."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return (
        df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent keys with their share: a look at skew before a join."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    return counts.orderBy(F.desc("n"), key).limit(k).withColumn(
        "share", F.round(F.col("n") / F.lit(total), 6)
    )


def build_cube(df: DataFrame, dims: list[str], sums: list[str]) -> DataFrame:
    """Sum and count for every subset of ``dims``; ``level`` tells which are rolled up.

    The finest grouping is computed first, so the 2^n expansion runs on its few
    rows and not on the input.
    """
    base = df.groupBy(*dims).agg(
        *[F.sum(s).alias(f"sum_{s}") for s in sums], F.count("*").alias("n_rows")
    )
    return base.cube(*dims).agg(
        F.grouping_id(*dims).cast("bigint").alias("level"),
        *[F.sum(f"sum_{s}").alias(f"sum_{s}") for s in sums],
        F.sum("n_rows").alias("n_rows"),
    )


def query_cube(cube: DataFrame, dims: list[str], by: list[str], where: dict[str, object] | None = None) -> DataFrame:
    """Answer a grouping from a cube: only sums and counts are stored, so only they can be asked."""
    where = where or {}
    unknown = [d for d in [*by, *where] if d not in dims]
    if unknown:
        raise ValueError(f"not a dimension of the cube: {unknown}")
    kept = set(by) | set(where)
    # The first dimension is the highest bit; a set bit is rolled up.
    level = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in kept)
    rows = cube.filter(F.col("level") == level)
    for dim, value in where.items():
        rows = rows.filter(F.col(dim).eqNullSafe(F.lit(value)))
    measures = [c for c in cube.columns if c not in dims and c != "level"]
    return rows.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures])


def roll_up(segments: DataFrame, ts: str, unit: str, by: list[str], sums: list[str]) -> DataFrame:
    """Merge rows of a fine time grain into a coarser one by adding their measures."""
    return segments.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias(ts), *by).agg(
        *[F.sum(s).alias(s) for s in sums]
    )
