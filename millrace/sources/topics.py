"""Log topics as tables.

All functions take and give the columns of Spark's Kafka source: ``topic,
partition, offset, key, value, timestamp``.  The Kafka reader itself needs the
connector jar; a table with these columns serves as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, servers: str, topic: str, streaming: bool = False,
               starting: str = "earliest", fail_on_data_loss: bool = True,
               max_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic as a batch table or a stream."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower(),
        }
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def as_topic(df: DataFrame, topic: str, key: Column, value: Column, offset: Column,
             ts: Column, partitions: int) -> DataFrame:
    """Shape a table like a topic; ``offset`` is a dense row number from 0."""
    return df.select(
        F.lit(topic).alias("topic"),
        (offset % partitions).cast("int").alias("partition"),
        F.floor(offset / partitions).cast("bigint").alias("offset"),
        key.cast("string").alias("key"),
        value.alias("value"),
        ts.alias("timestamp"),
    )


def topic_table(df: DataFrame, ddl: str) -> DataFrame:
    """JSON values as typed columns; the raw message stays in ``_message``."""
    message = F.col("value").cast("string")
    parsed = df.select(
        F.col("partition").alias("_partition"), F.col("offset").alias("_offset"),
        F.col("key").cast("string").alias("_key"), message.alias("_message"),
        F.from_json(message, ddl).alias("d"),
    )
    return parsed.select("_partition", "_offset", "_key", "_message", "d.*")
