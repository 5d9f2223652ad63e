"""Per-key ordered computations that do not put a large key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, which
fails once a single key holds a large share of the table.  Here the frequent keys
are found first.  Those below a share keep the plain window and its one shuffle.  Rows of a
large key are range partitioned on (keys, order) and so spread over many chunks;
window functions run inside (chunk, key), and what has to cross a chunk border is
carried over separately.  Only a key that continues from the chunk before needs a
carry, hence at most one carry row per chunk: it is broadcast safely whatever the
size of the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import shuffle_width, write_through

CHUNK = "_chunk"
SKETCH_MOST = 1_000_000  # the sketch tracks no more items


@dataclass(frozen=True)
class Ordered:
    """Rows tagged with a chunk number; within a key it grows with ``order``."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def window(self):
        return Window.partitionBy(CHUNK, *self.keys).orderBy(*self.order)

    def with_df(self, df: DataFrame) -> "Ordered":
        return replace(self, df=df)

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)


def key_hash(keys: list[str]) -> Column:
    """One number per key value; NULL has one too.  Keys that collide are only treated alike."""
    return F.xxhash64(*keys)


def large_keys(df: DataFrame, keys: list[str], share: float) -> dict[int, int]:
    """``key_hash`` of the keys above ``share`` of the rows, and in how many parts of
    that share each would fall.

    A sketch of the most frequent keys finds them in one pass without shuffling a key:
    each task sends a summary of bounded size.  Its counts are right up to a few percent
    of ``share``, which is enough to decide what is spread; results do not depend on it.
    There are at most ``1 / share`` keys, none in an empty table.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    most = min(math.ceil(1 / share), SKETCH_MOST)
    items = min(max(64 * most, 4096), SKETCH_MOST)
    found = df.select(key_hash(keys).alias("_h")).agg(
        F.expr(f"approx_top_k(_h, {most}, {items})").alias("top"), F.count("*").alias("n")).first()
    least = found["n"] * share
    return {r["item"]: math.ceil(r["count"] / least) for r in found["top"] or [] if r["count"] > least}


def ordered(df: DataFrame, keys: list[str], order: list[str],
            chunks: int | None = None, share: float | None = None) -> Ordered:
    """Tag ``df`` with chunks; ``order`` must break all ties within a key.

    Keys above ``share`` of the rows (all rows when there are no keys) are spread
    over ``chunks``; the others stay whole in chunk 0.  The spread rows are written
    to the shared folder: range borders come from a sample, so chunk numbers have
    to be fixed before they are used twice.  ``df`` is read up to three times (key
    sketch, small keys, large keys): write a costly one through before.
    """
    n = chunks or shuffle_width(df.sparkSession)

    def spread(rows: DataFrame) -> DataFrame:
        tagged = rows.repartitionByRange(n, *keys, *order).withColumn(
            CHUNK, F.spark_partition_id() + 1
        )
        return write_through(tagged, "ordered")

    if not keys:
        return Ordered(spread(df), (), tuple(order))
    large = large_keys(df, keys, share or 1.0 / n)
    whole = df.withColumn(CHUNK, F.lit(0))
    if large:
        is_large = key_hash(keys).isin(list(large))
        whole = whole.filter(~is_large).unionByName(spread(df.filter(is_large)))
    return Ordered(whole, tuple(keys), tuple(order))


def _chain(o: Ordered, partial: Column, over) -> DataFrame:
    """Fold per-(chunk, key) partials over the earlier chunks of the key."""
    # Chunk 0 holds whole keys, which carry nothing.
    per = o.df.filter(F.col(CHUNK) > 0).groupBy(CHUNK, *o.keys).agg(partial.alias("__part"))
    w = Window.partitionBy(*o.keys).orderBy(CHUNK) if o.keys else Window.orderBy(CHUNK)
    per = per.withColumn("__carry", over(F.col("__part"), w))
    # One row per chunk at most: the key it shares with the chunk before.
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(o.keys)]
    return per.filter("__carry IS NOT NULL").select(F.col(CHUNK).alias("_c"), *names, "__carry")


def _attach(o: Ordered, df: DataFrame, carry: DataFrame) -> DataFrame:
    cond = F.col(CHUNK) == F.col("_c")
    for i, k in enumerate(o.keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = df.join(F.broadcast(carry), cond, "left")
    return joined.drop("_c", *[f"_k{i}" for i in range(len(o.keys))])


def with_previous(o: Ordered, **columns: str) -> Ordered:
    """Add ``name`` = value of ``columns[name]`` in the row before, within the key."""
    payload = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    carry = _chain(
        o,
        F.max_by(payload, F.struct(*o.order)),
        lambda part, w: F.lag(part).over(w),
    )
    w = o.window()
    # Lags of plain columns are cheaper than one of a struct; the flag tells a first
    # row from one whose predecessor holds NULL.
    lags = {f"__lag_{name}": F.lag(c).over(w) for name, c in columns.items()}
    df = _attach(o, o.df.withColumns({**lags, "__first": F.lag(F.lit(True)).over(w).isNull()}), carry)
    for name in columns:
        df = df.withColumn(
            name, F.when(F.col("__first"), F.col("__carry")[name]).otherwise(F.col(f"__lag_{name}"))
        )
    return o.with_df(df.drop("__first", "__carry", *lags))


def _with_running(o: Ordered, name: str, value: Column, agg, merge) -> Ordered:
    base = o.with_df(o.df.withColumn("__v", value))
    carry = _chain(
        base,
        agg("__v"),
        lambda part, w: agg(part).over(w.rowsBetween(Window.unboundedPreceding, -1)),
    )
    upto = base.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = _attach(base, base.df.withColumn("__run", agg("__v").over(upto)), carry)
    both = merge(F.col("__carry"), F.col("__run"))
    # One side null (no value so far) leaves the other, as in a plain running window.
    total = F.coalesce(both, F.col("__carry"), F.col("__run"))
    return o.with_df(df.withColumn(name, total).drop("__v", "__run", "__carry"))


def with_running_sum(o: Ordered, name: str, value: Column) -> Ordered:
    """Add ``name`` = sum of ``value`` from the first row of the key to this row."""
    return _with_running(o, name, value, F.sum, lambda a, b: a + b)


def with_running_max(o: Ordered, name: str, value: Column) -> Ordered:
    """Add ``name`` = largest ``value`` from the first row of the key to this row."""
    return _with_running(o, name, value, F.max, lambda a, b: F.greatest(a, b))


def with_row_number(o: Ordered, name: str) -> Ordered:
    """Add the 1-based position of the row within its key."""
    return with_running_sum(o, name, F.lit(1).cast("bigint"))


def dense_ids(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """Number all rows 1..N in ``order`` without a single-task window."""
    return with_row_number(ordered(df, [], order), name).rows()


BINS = 1 << 16  # of one range in one pass
FEW = 20_000  # ranges that fit the plan of the next pass


def exact_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per key, exact, by counting: no sort, no shuffle of values.

    Every wanted rank starts with its key's range of values.  A pass counts the rows of
    each range in ``BINS`` bins of equal width, which partial sums make small before they
    leave a task; a rank goes on with the smallest and largest value of the bin it falls
    into, and is done when these are the same.  Bins follow the values' order, so the
    result is exact whatever the rounding; each pass narrows a range to a 65,536th, however
    many rows or how hot a key.  NULL values do not count, a NULL key is a key, NaN is
    larger than all numbers.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, own)], F.col(value).alias("_v")).filter("_v IS NOT NULL")
    wanted = sorted({*qs.values()})
    ranks = [f"CAST({f}((_total - 1) * {float(q)!r}D) AS BIGINT)" for q in wanted for f in ("floor", "ceil")]
    span = rows.groupBy(*own).agg(F.expr("count(*) AS _total"), F.expr("min(_v) AS _lo"), F.expr("max(_v) AS _hi"))
    goals = span.selectExpr(*own, "_total", "_lo", "_hi", f"explode(array_distinct(array({', '.join(ranks)}))) AS _rank", "0L AS _base")
    same_key = " AND ".join(["true", *[f"{n} <=> _r{n}" for n in own]])
    # Halves keep the difference finite; infinite and NaN ends leave the middle to one bin.
    share = "(CAST(_v AS DOUBLE) / 2 - CAST(_lo AS DOUBLE) / 2) / (CAST(_hi AS DOUBLE) / 2 - CAST(_lo AS DOUBLE) / 2)"
    place = f"""CASE WHEN _v = _lo THEN -1 WHEN _v = _hi THEN {BINS + 1} WHEN isnan({share}) THEN {BINS // 2}
                ELSE CAST(floor(least(greatest({share}, 0D), 1D) * {BINS}) AS INT) END"""
    of_range = ", ".join([*[f"_r{n}" for n in own], "_lo", "_hi"])
    upto = f"(PARTITION BY {of_range} ORDER BY _bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    spark, done, local = df.sparkSession, [], True

    def kept(table: DataFrame) -> DataFrame:
        """Cut the lineage: as local rows while they are few, else in the shared folder."""
        nonlocal local
        if local:
            some = table.limit(FEW + 1).toArrow()
            if some.num_rows <= FEW:
                return spark.createDataFrame(some)
            local = False
        return write_through(table, "quantiles")

    goals = kept(goals)
    while True:
        done.append(goals.filter("_lo <=> _hi"))
        goals = goals.filter("NOT _lo <=> _hi")
        if goals.isEmpty():
            break
        ranges = goals.selectExpr(*[f"{n} AS _r{n}" for n in own], "_lo", "_hi").distinct()
        met = rows.join(F.broadcast(ranges) if local else ranges, F.expr(f"{same_key} AND _v >= _lo AND _v <= _hi"))
        cells = met.groupBy(*[f"_r{n}" for n in own], "_lo", "_hi", F.expr(f"{place} AS _bin")).agg(
            F.expr("count(*) AS _n"), F.expr("min(_v) AS _from"), F.expr("max(_v) AS _to"))
        cells = cells.selectExpr(*[f"_r{n}" for n in own], "_lo AS _clo", "_hi AS _chi", "_n", "_from", "_to",
                                 f"coalesce(sum(_n) OVER {upto}, 0L) AS _before")
        hit = goals.join(cells, F.expr(f"{same_key} AND _lo <=> _clo AND _hi <=> _chi")) \
            .filter("_base + _before <= _rank AND _rank < _base + _before + _n")
        goals = kept(hit.selectExpr(*own, "_total", "_from AS _lo", "_to AS _hi", "_rank", "_base + _before AS _base"))
    found = reduce(DataFrame.unionByName, done)
    picks = [F.expr(f"max(CASE WHEN _rank = {r} THEN _lo END) AS _at{i}") for i, r in enumerate(ranks)]
    out = [F.col(n).alias(k) for k, n in zip(keys, own)]
    for name, q in qs.items():
        i, pos = 2 * wanted.index(q), f"((_total - 1) * {float(q)!r}D)"
        out.append(F.expr(f"CASE WHEN _at{i} = _at{i + 1} THEN _at{i} ELSE _at{i} + (_at{i + 1} - _at{i}) * ({pos} - floor({pos})) END").alias(name))
    return found.groupBy(*own, "_total").agg(*picks).select(*out)
