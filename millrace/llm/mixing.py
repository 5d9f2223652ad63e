"""Mix sources to target weights by Pareto order sampling.

Every source has a target in words.  Whole copies that all its documents get for
certain come first; the words still missing are a fixed-size sample.  A document's
rank is its random odds U / (1 - U) divided by its inclusion odds, and the lowest
ranks are taken until the words are reached.  U is a hash of the row, so a rerun
or a recomputed partition draws the same sample.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, lookup, unused, whole, write_through
from millrace.operators.ordered import dense_ids, ordered, with_row_number

BINS = 4096


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``.

    Sources by code point, null last, get ``weights`` in turn and share ``share``
    times all sizes; no target passes ``cap`` times its source's size, the excess
    goes to the others by weight.  Each round is one aggregate over the sources.
    """
    placed = sources.withColumn("_last", F.col("source").isNull().cast("int"))
    placed = write_through(dense_ids(placed, ["_last", "source"], "_nr"), "mix-order")
    first = placed.agg(F.min("_nr")).first()[0] or 0
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    slot = F.pmod(F.col("_nr") - F.lit(first), F.lit(len(weights))).cast("int")
    placed = placed.withColumn("_w", F.get(cycle, slot)).withColumn("_cap", F.lit(float(cap)) * F.col("source_size"))
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("_cap") < F.lit(level) * F.col("_w")
        held, open_weight, count = placed.agg(
            F.sum(F.when(over, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("_w"))), F.sum(over.cast("long"))).first()
        if count is None or count == capped or not open_weight:
            break
        level, capped = (share * total - held) / open_weight, count
    return placed.select("source", "source_size",
                         F.least(F.col("_cap"), F.lit(level) * F.col("_w")).alias("target"))


def _rank(seed: int, tilt: float) -> Column:
    """Random odds over inclusion odds, pressed into 0..1 (the order stays)."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size", "_same"), 11) + 0.5) / float(1 << 53)
    odds = F.pow(F.col("size") / F.col("_mean"), F.lit(tilt))  # times rest / (1 - rest), the same for the whole source
    x = u / (1 - u) / odds
    return x / (1 + x)


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``_same``, which numbers equal rows from 0.

    Rows are counted and laid out again, many equal ones in parts of ``BINS``.
    """
    parts = rows.groupBy(*rows.columns).agg(F.count("*").alias("_many")) \
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_many") - 1) / BINS))))
    parts = parts.repartition(*rows.columns, "_part")
    first = F.col("_part") * BINS
    return parts.select(*rows.columns, F.explode(F.sequence(first, F.least("_many", first + BINS) - 1)).alias("_same"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2,
        seed: int = 42, tilt: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``size`` counts words, null text has none; ``copies`` is how often the mix holds
    the document and ``taken`` its words times that.  Inclusion odds grow with size
    to the power ``tilt`` (0: equal).  The document that crosses the target is
    taken if that leaves the smaller gap, and one document more or less per source
    then closes what it can of the rest.  Documents without words are never drawn.
    A null source is a source of its own; repeated rows are drawn one by one and
    equal rows may stand for each other; an empty table gives an empty result.
    Only the three named columns are read.

    The cut is found in two steps so that a hot source stays spread: words summed
    per source and rank bin, then single documents inside the one crossing bin.
    """
    sized = write_through(_numbered(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(whole(text_col), F.lit(WORD)).cast("long").alias("size"))), "mix-sizes")
    sources = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.avg(F.when(F.col("size") > 0, F.col("size"))).alias("_mean"))
    plan = targets(sources.select("source", "source_size"), weights, share, cap)
    plan = lookup(plan, sources.select("source", "_mean"), "source")
    plan = plan.withColumn("_sure", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)) \
        .withColumn("_rest", F.col("target") - F.col("_sure") * F.col("source_size"))
    plan = write_through(plan, "mix-plan")

    drawn = lookup(sized, plan, "source")
    able = (F.col("size") > 0) & (F.col("_rest") > 0)
    drawn = drawn.withColumn("_rank", F.when(able, _rank(seed, tilt))) \
        .withColumn("_bin", F.floor(F.col("_rank") * BINS).cast("int"))
    by_source = Window.partitionBy("source").orderBy("_bin")
    bins = drawn.filter("_bin IS NOT NULL").groupBy("source", "_bin").agg(
        F.sum("size").alias("_words"), F.first("_rest").alias("_goal"))
    cuts = bins.withColumn("_upto", F.sum("_words").over(by_source)) \
        .filter("_upto - _words < _goal AND _upto >= _goal") \
        .groupBy("source").agg(F.min("_bin").alias("_cut"), F.min(F.col("_goal") - F.col("_upto") + F.col("_words")).alias("_need"))
    cuts = write_through(cuts, "mix-cuts")
    drawn = lookup(drawn, cuts, "source")
    edge = drawn.filter("_bin = _cut")
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "size", "_same")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    edge = edge.withColumn("_before", before).withColumn(
        "_more", F.expr("CAST(_before < _need AND _before + size - _need <= _need - _before AS INT)")).drop("_before")
    # A source without a cut (its rest is all it has, up to rounding) takes every document.
    rest = drawn.filter("_bin IS NULL OR _cut IS NULL OR _bin <> _cut").withColumn(
        "_more", F.expr("CAST(COALESCE(_bin IS NOT NULL AND (_cut IS NULL OR _bin < _cut), FALSE) AS INT)"))
    drawn = _last_unit(write_through(rest.unionByName(edge), "mix-drawn"))
    return drawn.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_sure") + F.col("_more")).cast("int").alias("copies"),
        (F.col("size") * (F.col("_sure") + F.col("_more"))).cast("long").alias("taken"))


def _last_unit(drawn: DataFrame) -> DataFrame:
    """Add or give back the one document per source that closes the gap at the cut best."""
    held = F.col("size") * (F.col("_sure") + F.col("_more"))
    gaps = drawn.groupBy("source").agg((F.first("target") - F.sum(held)).alias("_gap"))
    rows = lookup(drawn, gaps, "source")
    left = F.abs(F.abs("_gap") - F.col("size"))
    able = (F.col("_rank").isNotNull()) & (left < F.abs("_gap")) & (F.col("_more") == F.when(F.col("_gap") > 0, 0).otherwise(1))
    best = rows.filter(able).groupBy("source").agg(F.min(F.struct(left.alias("left"), "_rank", "doc_id", "size", "_same")).alias("_best"))
    rows = lookup(rows, best, "source")
    hit = (F.col("_rank") == F.col("_best._rank")) & F.col("doc_id").eqNullSafe(F.col("_best.doc_id")) \
        & (F.col("size") == F.col("_best.size")) & (F.col("_same") == F.col("_best._same"))
    return rows.withColumn("_more", F.when(hit, 1 - F.col("_more")).otherwise(F.col("_more")))


def apply(docs: DataFrame, **options) -> DataFrame:
    """The mixed table: each document as many times as the mix holds it, columns as in ``docs``.

    Documents whose rows agree in id, source and size share their copies' number per row.
    """
    own_id, own_source, text = (options.get(k, d) for k, d in (
        ("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text")))
    p_id, p_source, p_size, copies, rows, size, each, odd, copy, row, hashed = unused(
        docs, "_p_id", "_p_source", "_p_size", "_copies", "_rows", "_size", "_each", "_odd", "_copy", "_row", "_hash")
    plan = mix(docs, **options).groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("_sum"), F.count("*").alias("_many"))
    plan = plan.select(*[F.col(a).alias(b) for a, b in (
        ("doc_id", p_id), ("source", p_source), ("size", p_size), ("_sum", copies), ("_many", rows))])
    sized = docs.withColumn(size, F.regexp_count(whole(text), F.lit(WORD)).cast("long"))
    out = sized.join(plan, F.col(own_id).eqNullSafe(F.col(p_id))
                     & F.col(own_source).eqNullSafe(F.col(p_source)) & (F.col(size) == F.col(p_size)))
    # Rows that repeat id, source and size split their copies evenly, the first ones by content take the odd ones.
    out = out.withColumn(each, F.floor(F.col(copies) / F.col(rows)))
    out = out.withColumn(odd, F.col(copies) - F.col(each) * F.col(rows))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    hashable = [F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t and t != "variant"]
    uneven = write_through(out.filter(F.col(odd) > 0).select(
        *kept, p_id, p_source, p_size, each, odd, F.xxhash64(*hashable).alias(hashed),
        F.monotonically_increasing_id().alias(row)), "mix-uneven")
    parts = [out.filter(F.col(odd) == 0).select(*kept, F.col(each).alias(each))]
    if not uneven.isEmpty():
        # The rows are written, so their numbers are fixed; only keys and numbers are sorted.
        slim = uneven.select(F.col(p_id).alias("id"), F.col(p_source).alias("source"), F.col(p_size).alias("size"),
                             F.col(hashed).alias("hash"), F.col(row).alias("row"))
        place = with_row_number(ordered(slim, ["id", "source", "size"], ["hash", "row"]), "nr").rows()
        place = place.select(F.col("row").alias(copy), F.col("nr").alias(copies))
        uneven = uneven.join(place, F.col(row) == F.col(copy))
        parts.append(uneven.select(*kept, (F.col(each) + (F.col(copies) <= F.col(odd)).cast("long")).alias(each)))
    out = reduce(DataFrame.unionByName, parts)
    times = F.col(each).cast("int")
    return out.withColumn(copy, F.explode(F.array_repeat(F.lit(0), times))).select(*kept)
