"""UPDATE, DELETE and MERGE on a partitioned Parquet table, rewriting only what they touch.

Partitions with an affected row are found first; they are computed anew and put in
place by a dynamic partition overwrite, which stages its files before it swaps them.
Files of other partitions are not read again, moved or renamed.  One writer at a time.

Partition values are read as the text in their directories' names and written back as
that text, so ``month=01`` stays ``month=01``; conditions and values see them as text.
Partitions that lose all their rows are removed after the others are in place: a run
that fails in between has kept rows it should have deleted and is repaired by a rerun.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

from millrace.operators import changes
from millrace.session import settings, write_through
from millrace.sources.sinks import replace_partitions

DIR = "_dir"


def _within(df: DataFrame, parts: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the given partitions; the values prune the scan when they are known."""
    other = parts.select(*[F.col(c).alias(f"_p_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(other[f"_p_{c}"]) for c in by])
    return df.join(other, same, "left_semi")


def _rewrite(spark: SparkSession, path: str, by: list[str], touched: DataFrame, rows: DataFrame) -> int:
    """Replace the partitions of ``touched`` by ``rows``; the number of partitions touched.

    A partition that keeps no row gets no new file, so its directory is removed.
    """
    rows = write_through(rows, "rewrite")
    replace_partitions(rows, path, by)
    left = rows.select(*by).distinct().select(*[F.col(c).alias(f"_p_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [touched[c].eqNullSafe(left[f"_p_{c}"]) for c in by])
    gone = touched.filter(f"{DIR} IS NOT NULL").join(left, same, "left_anti").select(DIR).collect()
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in gone:
        # The metadata column holds a URI: blanks and percent signs of the name are escaped in it.
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row[DIR]))
        if not fs.delete(folder, True) and fs.exists(folder):
            raise OSError(f"cannot delete {row[DIR]}")
    return touched.count()


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The table with partition values as they are written in the directories' names."""
    with settings(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
        table = spark.read.parquet(path)
    if any(f.dataType == NullType() for f in table.schema):  # only the partition of NULL is left
        whole = StructType([StructField(f.name, StringType() if f.dataType == NullType() else f.dataType) for f in table.schema])
        return spark.read.schema(whole).parquet(path)
    return table


def _placed(table: DataFrame) -> DataFrame:
    """The table's rows with the directory they are in."""
    return table.withColumn(DIR, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))


def _touched(hit: DataFrame, by: list[str]) -> DataFrame:
    """Partitions of the rows in ``hit`` with their directories."""
    return write_through(hit.select(*by, DIR).distinct(), "touched")


def _check(by: list[str], values: dict[str, Column] | None) -> None:
    if values and set(by) & set(values):
        raise ValueError("a partition column cannot be set: delete the row and insert it")


def update(spark: SparkSession, path: str, by: list[str], condition: Column, values: dict[str, Column]) -> int:
    """UPDATE: set ``values`` where ``condition`` is true; NULL counts as false."""
    _check(by, values)
    table = _read(spark, path)
    touched = _touched(_placed(table).filter(condition), by)
    return _rewrite(spark, path, by, touched, changes.update_where(_within(table, touched, by), condition, values))


def delete(spark: SparkSession, path: str, by: list[str], condition: Column) -> int:
    """DELETE: rows where ``condition`` is true go; NULL counts as false."""
    table = _read(spark, path)
    touched = _touched(_placed(table).filter(condition), by)
    return _rewrite(spark, path, by, touched, changes.delete_where(_within(table, touched, by), condition))


def merge(spark: SparkSession, path: str, by: list[str], source: DataFrame, keys: list[str],
          matched: list[tuple[Column | None, dict[str, Column] | None]],
          insert: dict[str, Column] | None = None) -> int:
    """MERGE ``source`` on ``keys``; clauses as in ``changes.merge``.

    Touched are the partitions of target rows with a partner and those the new rows go to.
    """
    for _, values in matched:
        _check(by, values)
    table = _read(spark, path)
    source = write_through(source, "merge-source")
    parts = _touched(_placed(table).join(source.select(*keys), keys, "left_semi"), by)
    if insert is not None:
        fresh = source.join(table.select(*keys), keys, "left_anti").alias("s")
        types = dict(table.dtypes)
        goes = fresh.select(*[insert[c].cast(types[c]).alias(c) for c in by]).distinct()
        other = parts.select(*[F.col(c).alias(f"_p_{c}") for c in by])
        same = reduce(lambda a, b: a & b, [goes[c].eqNullSafe(other[f"_p_{c}"]) for c in by])
        new = goes.join(other, same, "left_anti").withColumn(DIR, F.lit(None).cast("string"))
        parts = write_through(parts.unionByName(new), "touched")
    merged = changes.merge(_within(table, parts, by), source, keys, matched, insert)
    return _rewrite(spark, path, by, parts, merged)
