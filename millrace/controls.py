"""What a user can do about a job's speed: caching, partitions, statistics, plans."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from millrace.session import shared_root

LEVELS = {
    "memory": StorageLevel.MEMORY_ONLY,
    "memory_and_disk": StorageLevel.MEMORY_AND_DISK,
    "disk": StorageLevel.DISK_ONLY,
    "memory_replicated": StorageLevel.MEMORY_ONLY_2,
}


def keep(df: DataFrame, level: str = "memory_and_disk") -> DataFrame:
    """Persist at a named level; the caller unpersists."""
    return df.persist(LEVELS[level])


def analyze(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Collect column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, as ``explain`` prints it."""
    jvm = df.sparkSession._jvm
    modes = jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def executed_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution has run it; no row comes to the driver."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()
