"""Data quality: reject handling, conformance, reconciliation, deduplication, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path


def with_reject_reason(df: DataFrame, value: str, required: dict[str, str]) -> DataFrame:
    """Parse JSON text into typed columns and say per row why it cannot be used.

    Adds one column per required field and ``violations``, an array that is empty for
    a good row: ``not_json`` (text that is no object, or names a field twice),
    ``missing:<field>`` (absent or null) or ``type:<field>``.  The text is parsed once; a
    number read as STRING comes without its trailing zeros.
    """
    parsed = F.try_variant_get(F.try_parse_json(F.col(value).cast("string")), "$", "map<string,variant>")
    # A generator of one row: a filter on what it makes is not pushed below it, which would parse again.
    rows = df.select("*", F.explode(F.array(parsed)).alias("_fields"))
    raw = {name: F.try_variant_get(F.try_element_at("_fields", F.lit(name)), "$", "string") for name in required}
    rows = rows.withColumn("_raw", F.struct(*[c.alias(f"f{i}") for i, c in enumerate(raw.values())]))
    checks = []
    for i, (name, kind) in enumerate(required.items()):
        typed = F.expr(f"try_cast(_raw.f{i} AS {kind})")
        rows = rows.withColumn(name, typed)
        checks.append(
            F.when(F.col(f"_raw.f{i}").isNull(), f"missing:{name}").when(typed.isNull(), f"type:{name}")
        )
    found = F.array_compact(F.array(*checks))
    return rows.withColumn(
        "violations", F.when(F.col("_fields").isNull(), F.array(F.lit("not_json"))).otherwise(found)
    ).drop("_fields", "_raw")


def split_bad(df: DataFrame, value: str, required: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows with typed columns, and dead letters with their origin and reason.

    The text is parsed once: both kinds are written to directories of their own in
    the shared folder, and each result reads one of them.
    """
    spark = df.sparkSession
    checked = with_reject_reason(df, value, required).withColumn("_good", F.size("violations") == 0)
    path = scratch_path(spark, "split")
    checked.write.partitionBy("_good").parquet(path)
    rows = spark.read.schema(checked.schema).parquet(path)
    good = rows.filter("_good").drop("violations", "_good")
    bad = rows.filter("NOT _good").withColumn("reason", F.array_join("violations", ","))
    origin = [c for c in ("topic", "partition", "offset", "key", value) if c in df.columns]
    return good, bad.select(*origin, "reason")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the table does not have."""
    return [c for c in required if c not in df.columns]


def reconcile(src: DataFrame, dst: DataFrame, by: list[str]) -> DataFrame:
    """Compare row counts of two tables: ok, short, extra or missing on one side."""
    a = src.groupBy(*by).agg(F.count("*").alias("n_src"))
    b = dst.groupBy(*by).agg(F.count("*").alias("n_dst"))
    both = a.join(b, by, "full_outer").fillna(0, ["n_src", "n_dst"])
    status = (
        F.when(F.col("n_dst") == 0, "missing").when(F.col("n_src") == 0, "unexpected")
        .when(F.col("n_dst") < F.col("n_src"), "short")
        .when(F.col("n_dst") > F.col("n_src"), "extra").otherwise("ok")
    )
    return both.withColumn("status", status)


def first_copy(df: DataFrame, ids: list[str], arrival: str) -> DataFrame:
    """One row per id, the first to arrive.  Copies are reduced before the shuffle.

    A row without an id is nobody's copy and stays.
    """
    rest = [c for c in df.columns if c not in ids]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    first = df.filter(known).groupBy(*ids).agg(F.min_by(F.struct(*rest), F.col(arrival)).alias("_first"))
    return first.select(*ids, "_first.*").unionByName(df.filter(~known))


def route_by_volume(df: DataFrame, by: str, threshold: int) -> DataFrame:
    """Row count per group and the route its load takes."""
    return df.groupBy(by).agg(F.count("*").alias("n")).withColumn(
        "route", F.when(F.col("n") > threshold, "large").otherwise("standard")
    )
