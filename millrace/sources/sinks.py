"""File and table sinks, partition layout, inserts, compaction and retention."""

from __future__ import annotations

import os
import shutil
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import epoch_parts, scalar
from millrace.session import scratch_path, settings, shuffle_width
from millrace.sources.files import MICROS

MB = 1024 * 1024
SMALL_FILE = 16 * MB
TARGET_FILE = 256 * MB


def csv(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").options(**MICROS).option("header", header).csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**MICROS).json(path)


def parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite",
            **options: str) -> None:
    """Parquet, optionally in ``k=v`` directories, with dictionary encoding."""
    writer = df.write.mode(mode).option("compression", "snappy")
    writer = writer.option("parquet.enable.dictionary", "true").options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def parquet_with_bloom(df: DataFrame, path: str, column: str, distinct: int) -> None:
    """Parquet whose row groups can be skipped in a point lookup on ``column``."""
    (
        df.repartitionByRange(column).sortWithinPartitions(column)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
        .parquet(path)
    )


def orc(df: DataFrame, path: str, by: list[str] | None = None, stripe_bytes: int = 64 * MB,
        bloom: str | None = None) -> None:
    """ORC with Snappy, a stripe size, a row index and an optional bloom filter."""
    writer = (
        df.write.mode("overwrite").option("compression", "snappy")
        .option("orc.stripe.size", str(stripe_bytes)).option("orc.create.index", "true")
    )
    if bloom:
        writer = writer.option("orc.bloom.filter.columns", bloom)
    (writer.partitionBy(*by) if by else writer).orc(path)


def gzip_text(lines: DataFrame, path: str, part: str) -> None:
    """Gzip text; ``part`` names the output directory each line belongs to."""
    lines.select("value", part).write.mode("overwrite").partitionBy(part).option(
        "compression", "gzip"
    ).text(path)


# ---------------------------------------------------------------- hourly layout

def hour_columns(ms: Column) -> list[Column]:
    """UTC year, month, day and hour of epoch milliseconds as zero-padded text."""
    return [part.alias(name) for name, part in epoch_parts(ms).items() if name in HOUR]


HOUR = ["year", "month", "day", "hour"]


def write_hourly(df: DataFrame, ts_ms: str, path: str, default_ms: int | None = None,
                 mode: str = "overwrite", file_rows: int = 0) -> None:
    """Snappy Parquet in ``year=/month=/day=/hour=`` directories from epoch milliseconds.

    A row without a time goes to ``default_ms``; without that to the default partition.
    No file holds more than ``file_rows`` rows (0: any number).  The rebalance step
    gives each hour as many files as its size asks for, so a busy hour is not one task.
    """
    ms = F.coalesce(F.col(ts_ms), F.lit(default_ms).cast("bigint"))
    out = df.select("*", *hour_columns(ms))
    parquet(out.hint("rebalance", *HOUR), path, HOUR, mode, maxRecordsPerFile=str(file_rows))


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Read the hourly layout back, keeping the padded text of its directories."""
    with settings(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
        return spark.read.parquet(path)


# ---------------------------------------------------------------------- inserts

def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``: a rerun repeats its result."""
    (
        df.hint("rebalance", *by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )


def insert_static(df: DataFrame, path: str, **partition: str) -> None:
    """Write all rows into the one partition given by value."""
    out = df
    for name, value in partition.items():
        out = out.withColumn(name, F.lit(value))
    replace_partitions(out, path, list(partition))


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Save a query as a table: managed, or external when ``path`` is given."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


# ------------------------------------------------------------------- compaction

def file_sizes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file: its directory and its size.  Contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(path)
    )
    return files.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.col("length").alias("bytes")
    )


def needs_compaction(spark: SparkSession, path: str, small: int = SMALL_FILE) -> DataFrame:
    """Directories with several files whose average size is below ``small`` bytes: ``dir, n, bytes``."""
    return file_sizes(spark, path).groupBy("dir").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes")
    ).filter((F.col("n") > 1) & (F.col("bytes") < F.col("n") * small))


def compact(spark: SparkSession, path: str, small: int = SMALL_FILE, target_bytes: int = TARGET_FILE) -> list[str]:
    """Rewrite the directories that need it, each to files of about ``target_bytes``; returns them.

    Every directory is judged by itself and others stay untouched.  The rewrite goes
    to a scratch folder first: AQE measures the shuffled data and fits the file count
    of each directory.  Then the new directories are renamed into place, so a failed
    run leaves the table as it was.  Directory names keep their text (``month=01``).
    Only names travel to the driver.
    """
    dirs = sorted(r["dir"] for r in needs_compaction(spark, path, small).select("dir").collect())
    if not dirs:
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(hadoop(path)).toString().rstrip("/")
    inner = {d: fs.makeQualified(hadoop(d)).toString().removeprefix(base).strip("/") for d in dirs}
    with settings(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
        rows = spark.read.option("basePath", base).parquet(*dirs)
    by = [part.split("=", 1)[0] for part in inner[dirs[0]].split("/") if part]
    staged = scratch_path(spark, "compact")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=str(target_bytes)):
        parquet(rows.hint("rebalance", *by) if by else rows.hint("rebalance"), staged, by)
    for part in inner.values():
        old, new = hadoop(f"{base}/{part}" if part else base), hadoop(f"{staged}/{part}" if part else staged)
        aside = hadoop(f"{staged}-replaced/{part or 'all'}")
        fs.mkdirs(aside.getParent())
        if not (fs.rename(old, aside) and fs.rename(new, old)):
            raise OSError(f"cannot move {new} to {old}; its former files are in {aside}")
    return dirs


def keep_recent(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the newest one."""
    newest = scalar(df, F.max(ts))
    return df.filter(F.col(ts) >= newest - F.expr(f"INTERVAL {days} DAYS"))


def many_small_files(df: DataFrame, rows: int, label: str, folder_files: int = 0) -> str:
    """Write ``df`` in files of at most ``rows`` rows, as a busy landing zone would.

    What a file costs is time to create it, so the rows are dealt to all cores first.
    Below a ``file:`` path Hadoop starts a process to set the mode of what it creates;
    flat rows get there through Arrow instead, in folders of ``folder_files`` files if
    there are more (0: in one folder).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    total = df.count()
    width = max(spark.sparkContext.defaultParallelism, shuffle_width(spark))
    width = min(width, -(-total // rows))
    spread = df.repartition(width) if width > 1 else df
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    flat = len(set(df.columns)) == len(df.columns) and all(type(f.dataType) in FLAT for f in df.schema.fields)
    if total and flat and uri.getScheme() == "file":
        _write_arrow(spread, rows, uri.getPath(), folder_files)
    else:
        spread.write.option("maxRecordsPerFile", rows).parquet(path)
    return path


# Types that Arrow and Spark store alike.
FLAT = {
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType,
}


def _write_arrow(df: DataFrame, rows: int, folder: str, folder_files: int) -> None:
    """Parquet files of at most ``rows`` rows in a folder that all machines share.

    Every attempt of a task has its own folder, and only those of attempts whose result
    arrived are moved into place, so a retry leaves nothing twice.
    """
    attempts = f"{folder}/_attempts"
    footer = {
        "org.apache.spark.version": df.sparkSession.version,
        "org.apache.spark.sql.parquet.row.metadata": df.schema.json(),
    }

    def write(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        os.makedirs(f"{attempts}/{own}")

        def put(n, table):
            held = pa.BufferOutputStream()
            with pq.ParquetWriter(held, table.schema, compression="snappy", use_dictionary=False, store_schema=False) as out:
                out.write_table(table)
                out.add_key_value_metadata(footer)
            with open(f"{attempts}/{own}/part-{part:05d}-{n:08d}.snappy.parquet", "xb") as file:
                file.write(held.getvalue())

        n, rest = 0, []
        for batch in batches:
            table = pa.Table.from_batches([*rest, batch])
            full = table.num_rows - table.num_rows % rows
            for at in range(0, full, rows):
                put(n, table.slice(at, rows))
                n += 1
            rest = table.slice(full).to_batches()
        if rest:
            put(n, pa.Table.from_batches(rest))
        yield pa.RecordBatch.from_pydict({"own": [own]})

    done = [f"{attempts}/{r['own']}" for r in df.mapInArrow(write, "own string").collect()]
    several = folder_files and sum(len(os.listdir(d)) for d in done) > folder_files
    for n, file in enumerate(f for d in done for f in os.scandir(d)):
        to = f"{folder}/{n // folder_files:06d}" if several else folder
        if several and n % folder_files == 0:
            os.mkdir(to)
        os.rename(file.path, f"{to}/{file.name}")
    shutil.rmtree(attempts, ignore_errors=True)
    open(f"{folder}/_SUCCESS", "wb").close()
