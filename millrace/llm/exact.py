"""Exact deduplication that no hot text can overload.

Copies are folded three times, each time by digest *and* full content: inside the
task that reads them (the partial aggregate), inside a salted digest group, and
over the winners of all salts.  A text with a third of all rows therefore sends one
row per task to each of its ``salts`` groups and one row per salt to the last step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_az, unused, whole, write_through


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), lower_az(whole(text_col)).alias("_text"))
    return rows.withColumn("_digest", digest(F.col("_text")))


def combine(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct text: ``_digest, _text, keep_id, group_size``."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
    by_salt = salted.groupBy("_digest", "_salt", "_text").agg(
        F.max("_id").alias("_keep"), F.count("*").alias("_n"))
    return by_salt.groupBy("_digest", "_text").agg(
        F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
           digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The largest id of a group stays; a null id is smaller than all others, and a
    group of null ids alone keeps one row with a null ``keep_id``.  Of repeated rows
    (same id and text) exactly one is kept.  Other columns are not read, so their
    names and nulls do not matter; an empty table gives an empty result.  A digest
    that stands for two texts (not with SHA-256) sends all rows through a join on
    the content itself.
    """
    rows = _rows(docs, id_col, text_col, digest)
    full = combine(rows, salts)
    found = write_through(full.select("_digest", "keep_id", "group_size"), "exact")
    clash = found.groupBy("_digest").agg(F.count("*").alias("_texts")).filter("_texts > 1")
    if clash.isEmpty():
        # Rows that repeat id and text are told apart by number only.
        once = rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n"), F.max(F.sha2("_text", 256)).alias("_sha")) \
            if digest is not sha256_hex else rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n")).withColumn("_sha", F.col("_digest"))
        out = once.join(found, "_digest")
    else:
        once = rows.groupBy("_id", "_digest", "_text").agg(F.count("*").alias("_n"))
        out = once.join(full, ["_digest", "_text"]).withColumn("_sha", F.sha2("_text", 256))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    return out.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    digest, keep_digest, keep_id = unused(docs, "_digest", "_keep_digest", "_keep_id")
    rows = _rows(docs, id_col, text_col, sha256_hex)
    found = write_through(combine(rows, salts).select(
        F.col("_digest").alias(keep_digest), F.col("keep_id").alias(keep_id)), "exact")
    marked = docs.withColumn(digest, sha256_hex(lower_az(whole(text_col))))
    kept = marked.join(found, (F.col(digest) == F.col(keep_digest))
                       & F.col(id_col).eqNullSafe(F.col(keep_id)), "left_semi")
    # Only a table that repeats a row in id and text needs another look at its rows.
    repeated = rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n")).filter("_n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_col, digest])
    return kept.drop(digest)
