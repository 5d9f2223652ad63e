"""The input tables, one Parquet file or directory each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read a table; ``columns`` narrows the scan to what the caller needs."""
    if name not in NAMES:
        raise ValueError(f"unknown table {name}")
    df = spark.read.parquet(path_of(sf_dir, name))
    return df.select(*columns) if columns else df
