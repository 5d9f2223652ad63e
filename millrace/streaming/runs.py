"""Sources, sinks and runs of streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.changes import last_change
from millrace.operators.joins import salted_join
from millrace.session import scratch_path
from millrace.sources import sinks


def table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a table, be it one file or a directory."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fs.getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def parse_values(topic: DataFrame, ddl: str) -> DataFrame:
    """Topic values as text, parsed as JSON and flattened."""
    text = topic.select(F.col("value").cast("string").alias("value"))
    return text.select(F.from_json("value", ddl).alias("d")).select("d.*")


def trigger_options(every: str | None = None, continuous: str | None = None) -> dict:
    """``processingTime`` or ``continuous`` for a running job; all there is, then stop, by default."""
    if continuous:
        return {"continuous": continuous}
    return {"processingTime": every} if every else {"availableNow": True}


def to_parquet(df: DataFrame, path: str, checkpoint: str, by: list[str] | None = None,
               every: str | None = None) -> StreamingQuery:
    """Append to Parquet.  The sink's own log makes each file count once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    if by:
        writer = writer.partitionBy(*by)
    return writer.trigger(**trigger_options(every)).start()


def to_console(df: DataFrame, checkpoint: str, mode: str = "update", rows: int = 20,
               every: str | None = None, continuous: str | None = None) -> StreamingQuery:
    """Print what changed, to watch a running stream; ``rows`` of each batch are shown."""
    writer = df.writeStream.format("console").outputMode(mode).option("numRows", rows).option("truncate", False)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger_options(every, continuous)).start()


def to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append",
              every: str | None = None, continuous: str | None = None) -> StreamingQuery:
    """Keep the rows as the driver's table ``name``: for trials and small aggregates only.

    With ``continuous`` rows pass without batches and arrive at least once; Spark then allows
    projections and filters only, from sources that support it (rate, Kafka).
    """
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger_options(every, continuous)).start()


def to_parquet_and_console(df: DataFrame, path: str, checkpoint: str, by: list[str] | None = None,
                           every: str | None = None, watch_every: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """One plan, two sinks: closed windows appended to Parquet, every change printed.

    Each sink is a query with its own offsets and state, so the console can stop or lag
    without holding up the files.
    """
    files = to_parquet(df, path, f"{checkpoint}/files", by, every)
    return files, to_console(df, f"{checkpoint}/console", every=watch_every)


def to_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "update",
               every: str | None = None) -> StreamingQuery:
    """Write every micro-batch to its own directory ``batch=<id>``, replacing it on a retry.

    In update mode this is an upsert log: the newest batch of a key holds its
    value (``latest_state``), and a retried batch repeats itself.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(save).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger_options(every)).start()
    )


def enrich(stream: DataFrame, table: DataFrame, key: str, path: str, checkpoint: str,
           salts: int = 8, every: str | None = None) -> StreamingQuery:
    """Join a stream to a table, batch by batch, with the batch's hot keys salted.

    A stream has no adaptive execution, so a plain join would send a busy key to
    one task; each micro-batch is joined as the table it is.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            out = salted_join(batch, table, key, salts)
            out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every)).start()
    )


def _numbered(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Directories ``<kind>=<number>`` of an upsert log by their number."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(hadoop(path))]
    return {int(n.split("=")[1]): f"{path}/{n}" for n in names if n.startswith(f"{kind}=")}


def latest_state(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The current row of each key in an upsert log: its newest fold and the batches after it."""
    folds = _numbered(spark, path, "fold")
    upto = max(folds, default=-1)
    later = [p for n, p in _numbered(spark, path, "batch").items() if n > upto]
    parts = []
    if later:
        parts.append(spark.read.option("basePath", path).parquet(*later).withColumnRenamed("batch", "write_id"))
    if folds:
        parts.append(spark.read.parquet(folds[upto]).withColumn("write_id", F.lit(upto)))
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].select(parts[0].columns))
    return last_change(log, keys).drop("write_id")


def fold_state(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Compact an upsert log in place; the number of its newest batch.

    The current rows are written aside and published as ``fold=<number>`` by one rename.
    Readers take the newest fold and only batches after it, so what it covers can then be
    deleted, and a last rename makes it the newest batch.  A fold that fails at any step
    leaves every key's current row readable, and the next one goes on from there.  Fold between runs of the stream, which then goes on with the next
    batch number.
    """
    folds, batches = _numbered(spark, path, "fold"), _numbered(spark, path, "batch")
    newest = max([*folds, *batches])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if newest not in folds:
        aside = scratch_path(spark, "fold")
        latest_state(spark, path, keys).write.parquet(aside)
        if not fs.rename(hadoop(aside), hadoop(f"{path}/fold={newest}")):
            raise OSError(f"cannot move {aside} to {path}/fold={newest}")
    for number, old in [*batches.items(), *((n, p) for n, p in folds.items() if n < newest)]:
        if number <= newest:
            _drop(fs, hadoop(old))
    if not fs.rename(hadoop(f"{path}/fold={newest}"), hadoop(f"{path}/batch={newest}")):
        raise OSError(f"cannot move {path}/fold={newest}")
    return newest


def _drop(fs, folder) -> None:
    if not fs.delete(folder, True) and fs.exists(folder):
        raise OSError(f"cannot delete {folder}")


def hourly_ingest(df: DataFrame, ts_ms: str, path: str, checkpoint: str, default_ms: int | None,
                  every: str | None = "10 seconds", file_rows: int = 1000) -> StreamingQuery:
    """Micro-batches into hourly partitions; offsets are committed after the write.

    A file is flushed at ``file_rows`` rows.  Rows without a time go to the hour of
    ``default_ms``; with None they stay apart in the default partition.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        sinks.write_hourly(batch, ts_ms, f"{path}/batch={batch_id}", default_ms, file_rows=file_rows)

    return (
        df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every)).start()
    )


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` run to end."""
    query.awaitTermination()
    return query


def dropped_late(query: StreamingQuery, every: float = 0.5) -> int:
    """Wait for an ``availableNow`` run to end; the rows its watermark dropped.

    A query remembers its last progress reports only, so they are gathered by batch
    while it runs; a batch whose report was missed is an error and not a zero.
    """
    seen: dict[int, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(every)
        for progress in query.recentProgress:
            seen[progress["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
    if seen and len(seen) != max(seen) - min(seen) + 1:
        raise RuntimeError("progress reports were lost: raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(seen.values())
