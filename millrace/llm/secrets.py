"""Secret scans over a ledger of blobs.

A text is a blob, named by its SHA-256; documents are the paths at which blobs
stand.  The ledger remembers which blob was scanned under which rule version and
what was found, so each run scans only pairs it has not seen, once per blob however
many documents hold it.  Findings are then joined back to all documents.

Everything is DataFrame functions.  A match's place is the length of what ``split``
leaves before it plus the matches before it; lengths are in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import lookup, whole, write_through
from millrace.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int  # whose length counts
    least: int
    version: int
    base: bool = True


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, 1),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, 1),
    Rule("hex", r"[0-9a-f]+", 0, 16, 1),
    # Further public credential formats, under a rule version of their own.
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, 2, False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20, 2, False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, 2, False),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20, 2, False),
)
LEDGER = "blob string, rule_version int, spans array<struct<start:int,rule:int,end:int>>"


def _present(rule: Rule) -> str:
    """A pattern that is in the text if a match of the rule is: spares the other texts."""
    return r"[0-9a-f]{%d}" % rule.least if rule.kind == "hex" else rule.pattern


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All runs below ``path``; a ledger that does not exist yet is empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if not exists:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(path)


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Spans of ``(blob, text, versions)``, one row per blob: one row per blob and version, also without a find."""
    found = []
    for nr, rule in enumerate(rules):
        due = F.array_contains("versions", rule.version) & F.col("text").rlike(_present(rule))
        pattern = F.lit(rule.pattern)
        found.append(F.when(due, F.transform(
            F.arrays_zip(
                F.regexp_extract_all("text", pattern, F.lit(0)).alias("m"),
                F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("g"),
                F.transform(F.split("text", rule.pattern, -1), F.char_length).alias("gap"),
            ),
            # split leaves one piece more than there are matches
            lambda z: F.struct(F.lit(nr).alias("rule"), z["gap"].alias("gap"), F.char_length(z["m"]).alias("n"),
                               F.char_length(z["g"]).alias("own")))).otherwise(F.array()))
    hits = texts.select("blob", F.concat(*found).alias("_hits")).filter(F.size("_hits") > 0) \
        .select("blob", F.posexplode("_hits").alias("_pos", "_hit")).select("blob", "_pos", "_hit.*")
    order = Window.partitionBy("blob", "rule").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("end", F.sum(F.col("gap") + F.coalesce("n", F.lit(0))).over(order).cast("int"))
    least = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (i, r.least)]), F.col("rule"))
    version = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (i, r.version)]), F.col("rule"))
    spans = hits.filter(F.col("n").isNotNull() & (F.col("own") >= least)).select(
        "blob", version.alias("rule_version"),
        F.struct((F.col("end") - F.col("n")).alias("start"), "rule", "end").alias("_span"))
    spans = spans.groupBy("blob", "rule_version").agg(F.sort_array(F.collect_list("_span")).alias("spans"))
    pairs = texts.select("blob", F.explode("versions").alias("rule_version"))
    return lookup(pairs, spans, "blob", "rule_version").select(
        "blob", "rule_version", F.coalesce("spans", F.array().cast("array<struct<start:int,rule:int,end:int>>")).alias("spans"))


def update_ledger(docs: DataFrame, paths: DataFrame, ledger_path: str, rules: tuple[Rule, ...]) -> int:
    """Scan the unseen pairs of blob and rule version and append them; the number of pairs scanned.

    Each run writes a directory of its own, so a failed run leaves no half entry.
    """
    spark = docs.sparkSession
    ledger = read_ledger(spark, ledger_path)
    known = ledger.groupBy("blob").agg(F.collect_set("rule_version").alias("_known"))
    versions = F.array(*[F.lit(v) for v in sorted({r.version for r in rules})])
    unseen = paths.groupBy("blob").agg(F.min("doc_id").alias("_at"))
    unseen = lookup(unseen, known, "blob").select(
        F.col("blob").alias("_blob"), "_at",
        F.array_except(versions, F.coalesce("_known", F.array().cast("array<int>"))).alias("versions")
    ).filter(F.size("versions") > 0)
    # Rows that repeat id and text, or a text without any id, still come several times.
    texts = docs.join(unseen, docs["doc_id"].eqNullSafe(F.col("_at")) & (docs["blob"] == F.col("_blob"))) \
        .select("blob", "text", "versions").dropDuplicates(["blob"])
    done = scan(texts, rules)
    target = f"{ledger_path.rstrip('/')}/{scratch_path(spark, 'run').rsplit('/', 1)[1]}"
    done.write.parquet(target)
    return spark.read.schema(LEDGER).parquet(target).count()


def find(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, blob, spans`` (rule number, start, end).

    Base kinds are leftmost and do not overlap within a kind; matches below a kind's
    least length are dropped after matching, so they still use up their characters.
    Null text is the empty blob.  Null ids, repeated rows and repeated texts each keep
    their row; other columns are not read; an empty table gives an empty result.
    Without ``ledger_path`` the ledger is new and every blob is scanned.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    texts = texts.withColumn("blob", F.sha2("text", 256))
    paths = write_through(texts.select("doc_id", "blob"), "secrets-paths")
    path = ledger_path or scratch_path(spark, "secrets-ledger")
    update_ledger(texts, paths, path, rules)
    wanted = sorted({r.version for r in rules})
    entries = read_ledger(spark, path).filter(F.col("rule_version").isin(wanted) & (F.size("spans") > 0)) \
        .dropDuplicates(["blob", "rule_version"]).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return lookup(paths, entries, "blob").select(
        "doc_id", "blob", F.coalesce(F.sort_array("spans"), F.array().cast("array<struct<start:int,rule:int,end:int>>")).alias("spans"))
