"""File scans.  Every path may be any Hadoop URI (hdfs, s3a, abfs, gs, file)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import scratch_path, shuffle_width

# Text formats keep the microseconds of a timestamp only when told to.
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a header line; types come from a pass over (a share of) the data."""
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .option("samplingRatio", sampling_ratio).csv(path)
    )


def delimited(spark: SparkSession, path: str, ddl: str, sep: str = ",") -> DataFrame:
    """Delimited text without header; a field that does not fit its type is NULL."""
    return spark.read.schema(ddl).options(**MICROS).option("sep", sep).option("mode", "PERMISSIVE").csv(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def json_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).options(**MICROS).json(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def multi_file(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` as one table, with the file each row is from.

    For every file it opens, Spark copies its settings under a lock that all tasks of a
    machine share.  So when there are many files, small ones of plain columns come as
    bytes, which Arrow reads.  Columns are Spark's in any case: it merges all schemas.
    The driver lists what it reads, so folders of very many files are read in rounds,
    whose rows are kept in the shared folder.
    """
    rounds = _rounds(spark, path)
    if len(rounds) < 2:
        return _with_file(spark, [path])
    staged = scratch_path(spark, "multi-file")
    parts = []
    for paths in rounds:
        try:
            rows = _with_file(spark, paths)
        except AnalysisException as e:
            # Folders without data files; if all are, Spark says so below.
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        parts.append(f"{staged}/{len(parts):06d}")
        rows.write.parquet(parts[-1])
    if not parts:
        return _with_file(spark, [path])
    rows = spark.read.option("mergeSchema", True).parquet(*parts)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "file"], "file")


def _rounds(spark: SparkSession, path: str) -> list[list[str]]:
    """What lies in ``path``, in path order, in lists of about ``ROUND`` files; no list if they are few."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    # A pattern is for Spark to resolve.
    if any(c in path for c in GLOB) or not fs.exists(hadoop):
        return []
    inside = fs.listStatus(hadoop)
    if len(inside) > FOLDERS:
        return []  # one folder, which is listed at once in any case
    seen = sorted((s.getPath().getName() + "/" * s.isDirectory(), s.getPath(), s.isDirectory()) for s in inside)
    seen = [(p, folder) for name, p, folder in seen if not name.startswith(("_", "."))]
    rounds, held = [], ROUND
    for p, folder in seen:
        n = fs.getContentSummary(p).getFileCount() if folder else 1
        if held + n > ROUND:
            rounds.append([])
            held = 0
        rounds[-1].append(p.toString())
        held += n
    return [] if any(c in p.getName() for p, _ in seen for c in GLOB) else rounds


def _with_file(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    schema, by_spark = rows.schema, rows.withColumn("file", F.col("_metadata.file_path"))
    if (
        not schema or any(type(f.dataType) not in PLAIN or f.name.lower() == "file" for f in schema)
        or spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "true"
        or len(rows._jdf.inputFiles()) < MANY
    ):
        return by_spark
    large = by_spark.filter(F.col("_metadata.file_size") >= SMALL)
    # Files are chosen when the scan is planned, so without large ones it has no partition.
    any_large = large._jdf.queryExecution().toRdd().getNumPartitions() > 0
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if not any_large:
        del rows, by_spark, large  # and with them the driver's list of the files
    small = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        .filter(F.col("_metadata.file_size") < SMALL).select("content", F.col("_metadata.file_path").alias("file"))
    )
    # Spark counts 4 MB for opening a file, which makes a task of 32 of them.
    width = max(4 * spark.sparkContext.defaultParallelism, shuffle_width(spark), size // TASK)
    small = _read_arrow(small.coalesce(width), schema, spark.conf.get("spark.sql.caseSensitive") == "true")
    return large.unionByName(small) if any_large else small


GLOB = "*?[{\\"
ROUND = 100_000
FOLDERS = 10_000
MANY = 1000
SMALL = 16 * 1024
TASK = 128 * 1024 * 1024
# Dates and instants are left to Spark, which knows the calendar of the file's writer.
PLAIN = {
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DecimalType, T.StringType, T.BinaryType, T.TimestampNTZType,
}


def _read_arrow(files: DataFrame, schema: T.StructType, case_sensitive: bool) -> DataFrame:
    """The rows of Parquet files given as ``content, file``, with the columns of ``schema`` and ``file``."""
    def key(name):
        return name if case_sensitive else name.lower()

    target = to_arrow_schema(schema)
    names = [key(f.name) for f in schema]

    def read(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.parquet as pq

        def table(content):
            source = pa.BufferReader(content.as_buffer())
            got = pq.ParquetFile(source, pre_buffer=False, coerce_int96_timestamp_unit="us").read(use_threads=False)
            if got.schema.equals(target):
                return got.replace_schema_metadata()
            at = {key(n): i for i, n in enumerate(got.column_names)}
            if len(at) < got.num_columns:
                raise ValueError(f"two columns of one name: {got.column_names}")
            columns = [
                got.column(at[n]).cast(f.type) if n in at else pa.nulls(got.num_rows, f.type)
                for n, f in zip(names, target)
            ]
            return pa.table(columns, schema=target)

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                tables = [table(content) for content in part.column("content")]
                of = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
                whole = pa.concat_tables(tables).append_column("file", part.column("file").take(pa.array(of)))
                yield from whole.combine_chunks().to_batches()

    return files.mapInArrow(read, T.StructType([*schema.fields, T.StructField("file", T.StringType(), False)]))


def partitioned(spark: SparkSession, root: str, *parts: str) -> DataFrame:
    """``k=v`` directories as columns; ``parts`` picks some of them and keeps the columns."""
    paths = [f"{root}/{p}" for p in parts] or [root]
    return spark.read.option("basePath", root).parquet(*paths)


def register_partitions(spark: SparkSession, table: str, ddl: str, by: str, path: str,
                        fmt: str = "parquet") -> DataFrame:
    """A table over directories written by others; its partitions are found by listing."""
    spark.sql(
        f"CREATE TABLE {table} ({ddl}) USING {fmt} PARTITIONED BY ({by}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(table)
    return spark.table(table)
