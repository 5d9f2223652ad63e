"""JDBC table scans, split by ranges of a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_options(url: str, table: str, partition_column: str, lower: int, upper: int,
                 partitions: int, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options for a scan in ``partitions`` parallel range queries."""
    if partitions < 1 or upper < lower:
        raise ValueError("need lower <= upper and at least one partition")
    return {
        "url": url, "dbtable": table, "partitionColumn": partition_column,
        "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": str(fetch_size),
        "pushDownPredicate": "true", "pushDownAggregate": "true", **extra,
    }


def scan(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(**kwargs)).load()
