"""One-permutation MinHash fingerprints as plain column expressions.

Every shingle is hashed once.  The top bits of the hash choose a bin, each bin keeps
its smallest hash, and the low-order byte of that hash is stored.  An empty bin
borrows from a filled one: of all filled bins the one that ranks first in an order of
its own, which two texts with the same filled bins share (optimal densification).
Agreeing bytes estimate the shingle similarity once chance agreement is taken out.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, lookup, lower_az, whole, write_through
from millrace.operators.ordered import dense_ids

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW = 255  # eight low-order bits are stored
CHANCE = 1 / (LOW + 1)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all word shingles; fewer words are one shingle, none give no hash."""
    def hashes(w: Column) -> Column:
        full = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))
        return F.when(F.size(w) >= size, full).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))) \
            .otherwise(F.array().cast("array<bigint>"))
    return let(words, hashes)


def _bin(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - BIN_BITS)


def _lowest(hashes: Column) -> Column:
    """The smallest hash of each filled bin: the first of each run of the sorted hashes."""
    return let(F.array_sort(hashes), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))


def _dense(lowest: Column) -> Column:
    def fill(low: Column, bins: Column) -> Column:
        def of(i: Column) -> Column:
            at = F.array_position(bins, i)
            rank = F.transform(low, lambda x: F.xxhash64(i, _bin(x)).bitwiseAND(~LOW).bitwiseOR(x.bitwiseAND(LOW)))
            return F.when(at > 0, F.get(low, (at - 1).cast("int"))).otherwise(F.array_min(rank)).bitwiseAND(LOW)
        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(BINS - 1).cast("bigint")), of)
    return let(lowest, lambda low: let(F.transform(low, _bin), lambda bins: F.when(
        F.size(low) > 0, fill(low, bins)).otherwise(F.array().cast("array<bigint>")))).cast("array<smallint>")


def fingerprint(text: Column, shingle: int = 5) -> Column:
    """``BINS`` stored bytes as small ints; no element for a text without words."""
    words = F.regexp_extract_all(lower_az(text), F.lit(WORD), F.lit(0))
    return _dense(_lowest(_shingles(words, shingle)))


def packed(stored: Column) -> Column:
    """The bytes as lowercase hex."""
    return F.lower(F.array_join(F.transform(stored, lambda v: F.lpad(F.hex(v.cast("bigint")), 2, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated shingle similarity, 0 to 1; two texts without words are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda v: v)) / F.lit(float(BINS))
    fixed = F.greatest(F.lit(0.0), (same - CHANCE) / (1 - CHANCE))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(fixed)


def fingerprints(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stored`` of every row.  Null text is empty; null ids and repeated rows keep
    their row; only the two named columns are read."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(whole(text_col), shingle).alias("stored"))


def _chunked(rows: DataFrame, target: int = 1000) -> DataFrame:
    """Tag rows with ``_piece``, growing with (``doc_id``, ``_tie``), of about ``target`` rows each.

    Borders are up to 1,000 quantiles; between two of them ids are split evenly.  Null ids, and
    an id that is several quantiles at once, are split by ``_tie``, a hash, so chunks stay
    small however large the table is and whatever its ids; only equal rows stay together.
    """
    count, nulls = rows.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    borders = max(1, min(1000, count // target))
    each = max(1, -(-count // (borders * target)))
    cut = rows.agg(F.percentile_approx("doc_id", [i / borders for i in range(borders + 1)], 10_000)).first()[0] or [0, 0]
    edges = sorted(set(cut))
    # Pieces of the edge itself, then those up to the next one.
    own = [each * cut.count(e) if cut.count(e) > 1 else 0 for e in edges]
    start = [0, *accumulate(n + each for n in own)][:-1]
    at = F.array(*[F.lit(e) for e in edges])
    slot = F.greatest(F.size(F.filter(at, lambda e: e <= F.col("doc_id"))) - 1, F.lit(0))
    low, high = F.get(at, slot), F.coalesce(F.get(at, slot + 1), F.get(at, slot) + 1)
    split = F.get(F.array(*[F.lit(n).cast("bigint") for n in own]), slot)
    share = F.col("_tie").cast("double") / F.lit(2.0 ** 64) + 0.5

    def part(x: Column, n: Column) -> Column:
        return F.greatest(F.least(F.floor(x * n), n - 1), F.lit(0).cast("bigint"))

    between = part((F.col("doc_id").cast("double") - low) / (high.cast("double") - low), F.lit(each).cast("bigint"))
    inside = F.when((split > 0) & (F.col("doc_id") == low), part(share, split)).otherwise(split + between)
    known = F.get(F.array(*[F.lit(n).cast("bigint") for n in start]), slot) + inside
    without = F.lit(max(1, -(-nulls // target))).cast("bigint")
    return rows.withColumn("_piece", F.when(F.col("doc_id").isNull(), part(share, without) - without).otherwise(known))


def with_next(rows: DataFrame, *columns: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """Add ``next_<column>`` from the next row by descending ``doc_id``, after the last from the first.

    ``derived`` columns are added before, once for every row, and get a next value too.

    Null ids come last, equal ids go by their text's hash.  Rows move once, by chunk;
    what crosses a chunk border is one row per chunk, found by a partial aggregate and
    added to the chunk before it.
    """
    derived = derived or {}
    rows = _chunked(rows.withColumn("_tie", F.xxhash64(*columns)))
    kept = [c for c in rows.columns if c != "_piece"]
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint")).alias("i"), F.col("_tie").alias("t"))
    heads = write_through(rows.groupBy("_piece").agg(
        F.max_by(F.struct(*kept), place).alias("_head")), "chunk-heads")
    order = write_through(dense_ids(heads.select("_piece"), ["_piece"], "_nr"), "chunk-order")
    first, last = order.agg(F.min("_nr"), F.max("_nr")).first()
    if first is None:
        rows = rows.withColumns(derived)
        return rows.select(*[c for c in rows.columns if c not in ("_tie", "_piece")],
                           *[F.col(c).alias(f"next_{c}") for c in (*columns, *derived)])
    # The head of a chunk follows the last row of the chunk above it; the top head follows the lowest row.
    after = order.select((F.when(F.col("_nr") == last, first - 1).otherwise(F.col("_nr")) + 1).alias("_nr"), F.col("_piece").alias("_of"))
    sentinels = order.join(after, "_nr").join(heads.withColumnRenamed("_piece", "_of"), "_of") \
        .select("_piece", "_head.*", F.lit(1).alias("_added"))
    both = rows.withColumn("_added", F.lit(0)).unionByName(sentinels)
    walk = Window.partitionBy("_piece").orderBy("_added", F.desc_nulls_last("doc_id"), F.desc("_tie"))
    both = both.withColumns(derived).withColumns({f"next_{c}": F.lead(c).over(walk) for c in (*columns, *derived)})
    return both.filter("_added = 0").drop("_added", "_piece", "_tie")
