"""Joins: plain, by strategy, by pattern, bucketed, salted and interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import large_keys
from millrace.operators.patterns import PATTERN_BYTES, contained
from millrace.session import scratch_name, scratch_path, shuffle_width, write_through

# A table up to this many rows may be sent to every executor.
BROADCAST_ROWS = 200_000
WIDE_ROW = 4096  # bytes


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Any join type; Catalyst and AQE choose the strategy from sizes."""
    return left.join(right, on, how)


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` is proven to hold at most ``rows`` rows.

    Every task stops counting behind that many, so a large side is not read to its end;
    one the optimiser expects to be far larger than ``rows`` wide rows is not read at all.
    """
    expected = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if expected > rows * WIDE_ROW:
        return False
    return df.limit(rows + 1).count() <= rows


def broadcast_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                   rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``right`` when its size is proven small, else shuffle both sides."""
    if fits_broadcast(right, rows):
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)


def sort_merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Shuffle and sort both sides; spills, and AQE splits skewed partitions."""
    return left.join(right.hint("merge"), on, how)


def shuffle_hash_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Shuffle both sides and hash ``right``, the side with few rows per key."""
    return left.join(right.hint("shuffle_hash"), on, how)


def filtered_probe(fact: DataFrame, dim: DataFrame, key: str, condition: Column) -> DataFrame:
    """Fact rows whose key survives a filter on the dimension."""
    keys = dim.filter(condition).select(key)
    return fact.join(keys, key, "left_semi")


# ---------------------------------------------------------------- pattern join

GRAM = 3


def like_join(texts: DataFrame, text_id: str, text: str,
              patterns: DataFrame, pattern_id: str, pattern: str,
              pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """Pairs (text_id, pattern_id) with ``text LIKE '%' || pattern || '%'``.

    Patterns of up to ``pattern_bytes`` (each counts 32 more) become one automaton, and each
    text is walked once where it is; only ids leave.  More patterns meet the texts on pieces.
    """
    kept = write_through(
        patterns.filter(F.col(pattern).isNotNull()).select(pattern_id, pattern), "patterns"
    )
    size = kept.agg(F.coalesce(F.sum(F.octet_length(pattern) + 32), F.lit(0))).first()[0]
    if size <= pattern_bytes:
        return contained(texts, text_id, text, kept, pattern_id, pattern)
    return like_join_on_pieces(texts, text_id, text, kept, pattern_id, pattern)


def like_join_on_pieces(texts: DataFrame, text_id: str, text: str,
                        patterns: DataFrame, pattern_id: str, pattern: str) -> DataFrame:
    """``like_join`` for patterns without a bound, by equality joins.

    Every pattern is looked up by one short piece of its own text (its anchor),
    the one that fewest texts contain.  Texts are split into their distinct pieces and
    equi-joined on it, and only these candidates are tested with LIKE: no nested
    loop.  ``%`` and ``_`` in the pattern keep their meaning, since the anchor
    comes from the longest stretch without them; a pattern of wildcards only has
    the empty anchor, which all texts contain.
    """
    pats = patterns.filter(F.col(pattern).isNotNull()).select(
        F.col(pattern_id).alias("_pid"), F.col(pattern).alias("_pattern")
    )
    # A backslash escapes the next character: both stay out of the anchor.
    runs = F.split(F.regexp_replace("_pattern", r"\\.|[%_]", "\u0000"), "\u0000")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))
    size = F.least(longest["n"], F.lit(GRAM))
    pats = pats.withColumn("_run", longest["r"]).withColumn("_size", size)
    pieces = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("_run") - F.col("_size") + 1, F.lit(1))),
        lambda i: F.substr(F.col("_run"), i, F.col("_size")),
    )
    options = pats.select("_pid", F.explode(F.array_distinct(pieces)).alias("_gram"))

    base = texts.filter(F.col(text).isNotNull()).select(
        F.col(text_id).alias("_tid"), F.col(text).alias("_text")
    )

    def grams(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        cut = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length("_text") - n + 1, F.lit(1))),
            lambda i: F.substr(F.col("_text"), i, F.lit(n)),
        )
        # A text shorter than the piece has none; a shorter piece would count twice.
        return F.when(F.length("_text") >= n, F.array_distinct(cut)).otherwise(
            F.array().cast("array<string>")
        )

    # Which piece lengths occur at all: at most GRAM + 1 values.
    sizes = sorted(r["_size"] for r in pats.select("_size").distinct().collect())
    if not sizes:
        sizes = [GRAM]
    text_grams = base.select(
        "_tid", F.explode(F.concat(*[grams(n) for n in sizes])).alias("_gram")
    )
    # Pieces no pattern uses are dropped where they are cut when the patterns are few.
    # The rest is read twice, for its frequencies and for the candidates.
    pieces_used = options.select("_gram").distinct()
    if fits_broadcast(pieces_used):
        pieces_used = F.broadcast(pieces_used)
    wanted = write_through(text_grams.join(pieces_used, "_gram", "left_semi"), "pieces")
    frequency = wanted.groupBy("_gram").agg(F.count("*").alias("_freq"))
    # A piece no text contains cannot match, so patterns lost here have no pairs.
    anchors = (
        options.join(frequency, "_gram", "left")
        .groupBy("_pid")
        .agg(F.min(F.struct(F.coalesce("_freq", F.lit(0)).alias("f"), F.col("_gram").alias("g"))).alias("_best"))
        .select("_pid", F.col("_best.g").alias("_gram"))
    )
    candidates = wanted.join(anchors, "_gram").select("_tid", "_pid")
    checked = (
        candidates.join(pats.select("_pid", "_pattern"), "_pid")
        .join(base, "_tid")
        .filter(F.like("_text", F.concat(F.lit("%"), F.col("_pattern"), F.lit("%"))))
    )
    return checked.select(F.col("_tid").alias(text_id), F.col("_pid").alias(pattern_id))


# ---------------------------------------------------------- salted and bucketed

def salt_pair(fact: DataFrame, dim: DataFrame, key: str, salts: int | None = None,
              share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_salt`` to join on next to ``key``.

    Only hot keys are salted, each by as many salts as it has parts of ``share`` of the
    rows (or ``salts``), so only their dimension rows are copied and only that often.
    The salt comes from the row's content, which makes a rerun of a lost task repeat it;
    copies of one row share a salt, and AQE splits that partition further.
    """
    share = share or 1.0 / shuffle_width(fact.sparkSession)
    hot = large_keys(fact, [key], share)
    if not hot:
        return fact.withColumn("_salt", F.lit(0)), dim.withColumn("_salt", F.lit(0))
    # At most 1 / share keys: a literal map goes with the plan.
    in_parts = F.create_map(*[F.lit(x) for h, n in hot.items() for x in (h, salts or n)])

    def parts(own: Column) -> Column:
        return F.element_at(in_parts, F.xxhash64(own))

    # Hashes depend on the type: the other side's key is hashed as this side's.
    same_type = F.col(key).try_cast(fact.schema[key].dataType)
    content = F.pmod(F.xxhash64(*fact.columns), parts(F.col(key))).cast("int")
    left = fact.withColumn("_salt", F.coalesce(content, F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce(parts(same_type), F.lit(1)) - 1)
    return left, dim.withColumn("_salt", F.explode(copies))


def salted_join(fact: DataFrame, dim: DataFrame, key: str, salts: int | None = None,
                share: float | None = None) -> DataFrame:
    """Inner join with the hot keys of ``fact`` spread over several partitions."""
    left, right = salt_pair(fact, dim, key, salts, share)
    return left.join(right.hint("merge"), [key, "_salt"]).drop("_salt")


def bucketed_table(df: DataFrame, keys: list[str], buckets: int, label: str = "bucketed") -> str:
    """Save ``df`` bucketed and sorted by ``keys``, one file per bucket; returns its name."""
    name = scratch_name(label)
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", scratch_path(df.sparkSession, name))
        .saveAsTable(name)
    )
    return name


def bucketed_pair(fact: DataFrame, dim: DataFrame, key: str, bucket_rows: int = 1_000_000) -> tuple[str, str]:
    """Save two tables for many later joins on ``key`` without a shuffle.

    The shuffle is paid once here, into buckets of about ``bucket_rows`` fact rows.  A
    hot key is salted before, down to that size, since nothing splits a bucket later.
    """
    rows = fact.count()
    buckets = max(shuffle_width(fact.sparkSession), -(-rows // bucket_rows))
    left, right = salt_pair(fact, dim, key, share=1.0 / buckets)
    keys = [key, "_salt"]
    return bucketed_table(left, keys, buckets, "fact"), bucketed_table(right, keys, buckets, "dim")


def bucketed_join(spark: SparkSession, left: str, right: str, key: str) -> DataFrame:
    """Inner join of a saved pair: no exchange in the plan."""
    return spark.table(left).join(spark.table(right).hint("merge"), [key, "_salt"]).drop("_salt")


def fanout_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pairs per key of ``left JOIN right``, from the counts of both sides."""
    a = left.groupBy(key).agg(F.count("*").alias("_a"))
    b = right.groupBy(key).agg(F.count("*").alias("_b"))
    return a.join(b, key).select(key, (F.col("_a") * F.col("_b")).alias("n_pairs"))


# ---------------------------------------------------------------- interval join

def interval_join(a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str,
                  lo_seconds: int, hi_seconds: int) -> DataFrame:
    """Inner join on ``key`` with ``b_ts`` in ``[a_ts + lo, a_ts + hi]``.

    Both sides are cut into slots as wide as the interval, so rows meet only
    within a key and slot; each ``a`` row looks into the slots its interval touches.
    """
    width = max(hi_seconds - lo_seconds, 1) * 1_000_000

    def slot(ts: str, shift_seconds: int = 0) -> Column:
        micros = F.unix_micros(F.col(ts).cast("timestamp")) + F.lit(shift_seconds * 1_000_000)
        return F.floor(micros / width).cast("bigint")

    left = a.withColumn(
        "_slot", F.explode(F.sequence(slot(a_ts, lo_seconds), slot(a_ts, hi_seconds)))
    )
    right = b.withColumn("_slot", slot(b_ts))
    lo = F.expr(f"INTERVAL '{lo_seconds}' SECOND")
    hi = F.expr(f"INTERVAL '{hi_seconds}' SECOND")
    joined = left.join(right, [key, "_slot"])
    return joined.filter(
        (F.col(b_ts) >= F.col(a_ts) + lo) & (F.col(b_ts) <= F.col(a_ts) + hi)
    ).drop("_slot")


def multiply_rows(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Every row ``times`` times, numbered from 0: the product with a short list."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
