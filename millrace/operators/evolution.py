"""Schema evolution: resolve records, judge versions, split framed messages."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The types a writer's type may be read as.
PROMOTIONS = {
    "int": ["long", "float", "double"],
    "long": ["float", "double"],
    "float": ["double"],
    "string": ["bytes"],
    "bytes": ["string"],
}
SPARK_TYPES = {
    "int": "int", "long": "bigint", "float": "float", "double": "double",
    "string": "string", "bytes": "binary", "boolean": "boolean",
}
MODES = ["BACKWARD", "FORWARD", "FULL", "NONE"]


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = False
    default: Any = None
    has_default: bool = False


def resolve(df: DataFrame, writer: list[Field], reader: list[Field]) -> DataFrame:
    """Read rows of one schema version with another.

    A field only the writer has is dropped; one only the reader has takes its
    default, or NULL when it may be null, and is an error otherwise.
    """
    have = {f.name: f for f in writer}
    out = []
    for f in reader:
        target = SPARK_TYPES[f.type]
        if f.name in have:
            source = have[f.name].type
            if source != f.type and f.type not in PROMOTIONS.get(source, []):
                raise ValueError(f"{f.name}: {source} cannot be read as {f.type}")
            out.append(F.col(f.name).cast(target).alias(f.name))
        elif f.has_default:
            out.append(F.lit(f.default).cast(target).alias(f.name))
        elif f.nullable:
            out.append(F.lit(None).cast(target).alias(f.name))
        else:
            raise ValueError(f"{f.name} has no default and the writer lacks it")
    return df.select(*out)


def _promotable(source: Column, target: Column) -> Column:
    test = source == target
    for name, wider in PROMOTIONS.items():
        test = test | ((source == name) & target.isin(wider))
    return test


def compatibility(fields: DataFrame, transitive: bool = False) -> DataFrame:
    """Judge the newest version of each subject against earlier ones, in every mode.

    ``fields`` has ``subject, version, field, type, has_default``.  The newest
    version meets its predecessor, or every earlier version when ``transitive``.
    BACKWARD: the new schema reads old records; FORWARD: the old reads new ones.
    """
    versions = fields.select("subject", "version").distinct()
    newest = versions.groupBy("subject").agg(F.max("version").alias("new"))
    older = versions.join(newest, "subject").filter("version < new")
    if not transitive:
        older = older.groupBy("subject", "new").agg(F.max("version").alias("version"))
    pairs = older.select("subject", F.col("version").alias("old"), "new")

    def side(which: str) -> DataFrame:
        return pairs.join(
            fields.withColumnRenamed("version", which), ["subject", which]
        ).select(
            "subject", "old", "new", "field", F.col("type").alias(f"{which}_type"),
            F.col("has_default").alias(f"{which}_default"),
        )

    both = side("old").join(side("new"), ["subject", "old", "new", "field"], "full_outer")
    only_new, only_old = F.col("old_type").isNull(), F.col("new_type").isNull()
    backward = F.when(only_new & ~F.col("new_default"), F.concat(F.lit("no default: "), "field")).when(
        ~only_new & ~only_old & ~_promotable(F.col("old_type"), F.col("new_type")),
        F.concat(F.lit("type: "), "field"),
    )
    forward = F.when(only_old & ~F.col("old_default"), F.concat(F.lit("no default: "), "field")).when(
        ~only_new & ~only_old & ~_promotable(F.col("new_type"), F.col("old_type")),
        F.concat(F.lit("type: "), "field"),
    )
    checked = both.withColumn("_b", backward).withColumn("_f", forward).withColumn(
        "mode", F.explode(F.array(*[F.lit(m) for m in MODES]))
    )
    uses_b, uses_f = F.col("mode").isin("BACKWARD", "FULL"), F.col("mode").isin("FORWARD", "FULL")
    problems = F.array_compact(F.array(F.when(uses_b, F.col("_b")), F.when(uses_f, F.col("_f"))))
    return (
        checked.withColumn("_p", problems)
        .groupBy("subject", "old", "new", "mode")
        .agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_p")))), "; ").alias("reasons"))
        .withColumn("ok", F.col("reasons") == "")
    )


def subject_name(strategy: str, topic: Column, record: Column) -> Column:
    """Subject of a schema: by topic, by record, or by both."""
    if strategy == "topic":
        return F.concat(topic, F.lit("-value"))
    if strategy == "record":
        return record
    if strategy == "topic_record":
        return F.concat(topic, F.lit("-"), record)
    raise ValueError(f"unknown strategy {strategy}")


def frame(schema_id: Column, payload: Column, magic: Column) -> Column:
    """Magic byte, four-byte big-endian schema id, payload."""
    return F.concat(
        F.unhex(F.lpad(F.hex(magic), 2, "0")), F.unhex(F.lpad(F.hex(schema_id), 8, "0")),
        F.encode(payload, "UTF-8"),
    )


def split_frame(df: DataFrame, value: str) -> DataFrame:
    """Add ``schema_id``, ``payload`` and ``reason``; a reject has the reason only."""
    body = F.col(value)
    reason = (
        F.when(body.isNull(), "empty")
        .when(F.length(body) < 5, "too short")
        .when(F.substring(body, 1, 1) != F.unhex(F.lit("00")), "bad magic byte")
    )
    good = F.col("reason").isNull()
    id_ = F.conv(F.hex(F.substring(body, 2, 4)), 16, 10).cast("bigint")
    return (
        df.withColumn("reason", reason)
        .withColumn("schema_id", F.when(good, id_))
        .withColumn("payload", F.when(good, F.expr(f"substring({value}, 6)")))
    )
