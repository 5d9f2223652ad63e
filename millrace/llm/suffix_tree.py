"""Scoring with a probabilistic suffix tree held in Spark tables.

Every word is a symbol, and so are the start and the end of a text.  A context of up to
``depth`` preceding symbols becomes a state if it is followed ``least`` times by one
symbol and if what follows it diverges from what follows its next shorter suffix.
Distributions are discounted and fall back along suffixes to the add-one model of single
tokens, which knows every word and one unseen word; a token is scored in the longest
state its history ends with.

Contexts and continuations have no share of the corpus to reach and no limit on their
number: ``least`` is a count, so the tree grows with the input.  Each length is counted,
tested and stored as a table, and scoring is a join.  The log probability of a text is a
sum over the sequences of symbols it holds, each with its own weight: what it adds as a
continuation, and what its state leaves to shorter suffixes as a context.  A text needs
no order in the join, therefore.

Sequences are shuffled by the range of their key, all that a task has of one range as
arrays in one row: about ``BUCKET`` bytes of text make a range, so their number grows
with the input.

Two things are broadcast, both bounded and without effect on results: the weights of
sequences above a share (``1 / share`` each length), whose occurrences need no join, and
``2 ** BITS`` bits saying which sequences are surely not in the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole, write_through

RARE, END, START = 0, 1, 2  # RARE: any word the corpus does not have
DISCOUNT = 0.75
BITS = 27
BUCKET = 4_000_000
AZ = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
GAP = np.isin(np.arange(256), [32, *range(9, 14)])
LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes
LONG = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """One to one on 64 bits."""
    for factor in (0xD6E8FEB86659FD93, 0xD6E8FEB86659FD93):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Symbol of each word: 64 bits of its hash, eight bytes at a time.  ``data`` has eight bytes more than the words."""
    blocks = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    size = end - begin
    out = _mixed(size.astype(np.uint64) + np.uint64(3))
    rest, at = np.arange(len(size)), 0
    while len(rest) and at < LONG:
        block = blocks[begin[rest] + at].view("<u8")[:, 0] & LOW[np.minimum(size[rest] - at, 8)]
        out[rest] = _mixed(out[rest] ^ block)
        at += 8
        rest = rest[size[rest] > at]
    for i in rest:
        word = data[begin[i]:end[i]].tobytes()
        out[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
    return out.view(np.int64)


def word(of: bytes) -> int:
    """Symbol of one word."""
    data = np.frombuffer(of + bytes(8), np.uint8)
    return int(hashed(data, np.array([0]), np.array([len(of)]))[0])


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece have about ``most`` bytes; one text is not cut."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + most, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def joined(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a sequence from its context's key and its last symbol."""
    x = context.view(np.uint64)
    return ((x << np.uint64(21)) | (x >> np.uint64(43))).view(np.int64) ^ symbol


def parted(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The context's key from that of the sequence and its last symbol."""
    x = (key ^ symbol).view(np.uint64)
    return ((x >> np.uint64(21)) | (x << np.uint64(43))).view(np.int64)


def _joined(context: str, symbol: str) -> Column:
    return F.expr(f"(shiftleft({context}, 21) | shiftrightunsigned({context}, 43)) ^ {symbol}")


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, all symbols with starts and ends, and each symbol's place in its text.  No text is null."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]) if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = ~GAP[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = np.flatnonzero(np.diff(at))  # a text's first and last byte bound its words
    first[at[some]], last[at[some + 1] - 1] = inside[at[some]], inside[at[some + 1] - 1]
    starts = np.flatnonzero(first)
    size = np.diff(np.searchsorted(starts, at))
    flat = hashed(np.append(AZ[raw], np.zeros(8, np.uint8)), starts, np.flatnonzero(last) + 1)
    begin = np.cumsum(size + 2) - size - 2
    out = np.full(int((size + 2).sum()), START, np.int64)
    out[np.arange(len(flat)) + np.repeat(2 * np.arange(len(size)) + 1, size)] = flat
    out[begin + size + 1] = END
    return size, out, np.arange(len(out)) - np.repeat(begin, size + 2)


def sequences(out: np.ndarray, longest: int) -> list[np.ndarray]:
    """For 0, 1, ... preceding symbols the key of the sequence ending at each place; those over a start mean nothing."""
    keys = [out]
    for _ in range(longest):
        keys.append(joined(np.concatenate([[0], keys[-1][:-1]]), out))
    return keys


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, -1 if missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Places(dict):
    """Place of a word in the tree's arrays, -1 if it is not held there."""

    def __init__(self, symbol: np.ndarray):
        self.symbol = symbol

    def __missing__(self, of: bytes) -> int:
        return int(_find(self.symbol, np.array([word(of)]))[0])


@dataclass
class Level:
    """Sequences of one length above the share: log10 weights as continuation and as context."""

    keys: np.ndarray
    logs: np.ndarray  # of count + 1, for single words
    own: np.ndarray
    back: np.ndarray

    @property
    def kept(self) -> np.ndarray:
        return self.back < 0


@dataclass
class Tree:
    """The part of the tables above the share, held in memory."""

    levels: list[Level]
    floor: float  # log10 of the add-one model's denominator
    bits: np.ndarray  # of all longer sequences with a weight, held or not

    @property
    def symbol(self) -> np.ndarray:
        return self.levels[0].keys

    @property
    def known(self) -> Places:
        return Places(self.symbol)

    def weighed(self, out: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Per symbol log10 of its count + 1, whether it is held, its weight; by length the keys to look up and their places."""
        keys, weight, rest = sequences(out, len(self.levels) - 1), np.zeros(len(out) + 1), []
        logs, held = np.zeros(len(out)), np.zeros(len(out), bool)
        for length, (level, key) in enumerate(zip(self.levels, keys)):
            able = np.flatnonzero(depth >= length)
            if length:
                able = able[has(self.bits, key[able])]
            at = _find(level.keys, key[able])
            hit = at >= 0
            place, at = able[hit], at[hit]
            weight[place] += level.own[at]
            after = level.back[at]
            weight[place[after < 0] + 1] += after[after < 0]
            if length == 0:
                logs[place], held[place] = level.logs[at], True
                rest.append(able[~hit & (depth[able] > 0)])
            else:
                rest.append(able[~hit])
        return logs, held, weight[:-1], [key[at] for key, at in zip(keys, rest)], rest

    def log10(self, out: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol by what is held (0 at starts)."""
        logs, _, weight, *_ = self.weighed(out, depth)
        return np.where(depth > 0, logs - self.floor + weight, 0.0)


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where a key is surely missing: one of its two bits is not set."""
    found = np.ones(len(keys), bool)
    for shift in (0, 32):
        left = np.flatnonzero(found)
        at = (keys[left] >> shift) & ((1 << BITS) - 1)
        found[left] = (bits[at >> 6] >> (at & 63)) & 1 == 1
    return found


def marked(table: DataFrame) -> np.ndarray:
    """Two bits for each ``key``; keys may share them.  At most ``2 ** (BITS - 6)`` rows come to the driver."""
    at = f"(key & {(1 << BITS) - 1}L)"
    rows = table.select("key").union(table.select(F.shiftright("key", 32))).groupBy(F.expr(f"cast(shiftright({at}, 6) as int)").alias("at")) \
        .agg(F.expr(f"bit_or(shiftleft(1L, cast({at} & 63 as int)))").alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return bits


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the values between each two bounds."""
    values = np.ascontiguousarray(values)
    ends = (bounds * (values.itemsize * (values.shape[1] if values.ndim > 1 else 1))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all blobs, one after another; null is empty."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(b.as_buffer(), kind) for b in column.drop_null())])


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bytes of each key that its range does not tell."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :8 - bits // 8]


def _long(column: pa.ChunkedArray, bits: int, bucket: int) -> np.ndarray:
    """The keys of all blobs of a range."""
    kept = 8 - bits // 8
    short = _flat(column, np.uint8).reshape(-1, kept)
    told = np.frombuffer((bucket >> bits % 8).to_bytes(8, "little"), np.uint8)[:8 - kept]
    return np.concatenate([short, np.broadcast_to(told, (len(short), 8 - kept))], 1).view(np.int64)[:, 0]


def _dealt(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges with any of the keys, which are in unsigned order, and the place where each begins, and the end."""
    edges = np.searchsorted(keys.view(np.uint64), np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    bounds = np.append(edges, len(keys))
    used = np.flatnonzero(np.diff(bounds))
    return used, np.append(bounds[used], len(keys))


def _steps(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ascending places between each two bounds as steps from the one before, which compress well."""
    steps = np.diff(places, prepend=places[:1] * 0)
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    steps[first] = places[first]
    return steps


def _places(steps: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The places from their steps."""
    ends = np.cumsum(steps, dtype=np.int64)
    before = np.append(0, ends)[bounds[:-1]]
    return (ends - np.repeat(before, np.diff(bounds))).astype(np.uint16)


def _ends(blobs: pa.ChunkedArray, size: int) -> np.ndarray:
    """Where each blob's values of ``size`` bytes begin when they are joined, and the end."""
    return np.append(0, np.cumsum(pc.fill_null(pc.binary_length(blobs), 0).to_numpy() // size, dtype=np.int64))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _bits(size: int) -> int:
    """Twos whose product is the number of ranges for ``size`` bytes of text."""
    return max(3, (size // BUCKET).bit_length())


def _summed(context: np.ndarray, symbol: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct ``key, context, symbol, n`` in unsigned order of their keys; each counts one without ``n``."""
    key = joined(context, symbol).view(np.uint64)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(np.ones(len(key[:1]), bool), key[1:] != key[:-1]))
    key, at = key[first].view(np.int64), order[first]
    if n is None:
        n = np.diff(np.append(first, len(order)))
    elif len(at):
        n = np.add.reduceat(n[order], first, dtype=np.int64)
    return key, context[at], symbol[at], n


def _counted(docs: DataFrame, text_col: str, length: int, bits: int, least: int, shared=None, most: int = 1_000_000) -> DataFrame:
    """``context, next, n`` of at least ``least`` over all texts, folded in each task before the shuffle.

    ``shared``: bits of the sequences one shorter that occur ``least`` times (words) or
    are in the tables.  A sequence is there only if the two shorter ones it begins and
    ends with are.  Without preceding symbols all words are given, ``keys, counts`` of
    each range in unsigned order as arrays in a row.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, nexts, size = [], [], 0

        def out():
            context, symbol = np.concatenate(contexts), np.concatenate(nexts)
            contexts.clear()
            nexts.clear()
            key, _, symbol, n = _summed(context, symbol)
            used, bounds = _dealt(key, bits)
            last = _blobs(symbol, bounds) if length else pa.nulls(len(used), pa.binary())
            batch = _batch(bucket=used.astype(np.int32), key=_blobs(_short(key, bits), bounds), next=last, n=_blobs(n.astype(np.int32), bounds))
            for start in range(0, len(used), 32):
                yield batch.slice(start, 32)
        for batch in pieces(batches, 0):
            _, symbol, depth = symbols(batch.column(0))
            at = np.flatnonzero(depth >= max(length, 1))
            if length == 0:
                contexts.append(np.zeros(len(at), np.int64))
            else:
                key = sequences(symbol, length - 1)[-1]
                there = has(shared.value, key)
                at = at[there[at] & there[at - 1]]
                contexts.append(key[at - 1])
            nexts.append(symbol[at])
            size += len(at)
            if size > most:
                yield from out()
                size = 0
        if size:
            yield from out()

    def fold(table: pa.Table) -> pa.Table:
        key = _long(table["key"], bits, table["bucket"][0].as_py())
        symbol = _flat(table["next"], np.int64) if length else key
        key, context, symbol, n = _summed(parted(key, symbol), symbol, _flat(table["n"], np.int32))
        if length == 0:
            ends = np.array([0, len(key)])
            return pa.table({"bucket": table["bucket"][:1], "keys": _blobs(key, ends), "counts": _blobs(n, ends),
                             "total": [int(n.sum())], "types": [len(key)]})
        kept = n >= least
        return pa.table({"context": context[kept], "next": symbol[kept], "n": n[kept]})

    blobs = docs.select(whole(text_col).alias("text")).mapInArrow(count, "bucket int, key binary, next binary, n binary")
    return blobs.groupBy("bucket").applyInArrow(
        fold, "context long, next long, n long" if length else "bucket int, keys binary, counts binary, total long, types long")


def _listed(words: DataFrame, least: float) -> DataFrame:
    """``key, n`` of the words that occur ``least`` times."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                n = np.frombuffer(counts.as_buffer(), np.int64)
                kept = n >= least
                yield _batch(key=np.frombuffer(keys.as_buffer(), np.int64)[kept], n=n[kept])
    return words.select("keys", "counts").mapInArrow(rows, "key long, n long")


def _settled(counts: DataFrame, shorter: DataFrame) -> DataFrame:
    """A length of the tree from its counts and the length before.

    ``key, short, n, logp, own, context, total, back``: the sequence, its suffix one
    shorter, natural logarithms of its probability, of its weight and of what its context
    leaves to the suffix (null: the context is no state).  The divergence of the counted
    distribution from the suffix's, continuations not counted taken together, times twice
    the context's count, must pass the mean plus three deviations of a chi-square with as
    many degrees of freedom as continuations.
    """
    contexts = shorter.select(F.col("key").alias("context"), F.col("n").alias("total"), F.col("short").alias("suffix"))
    rows = counts.join(contexts, "context").withColumn("short", F.when(F.col("suffix").isNull(), F.col("next"))
                                                       .otherwise(_joined("suffix", "next")))
    rows = rows.join(shorter.select(F.col("key").alias("short"), F.col("logp").alias("logq")), "short")
    p, q = F.col("n") / F.col("total"), F.exp("logq")
    states = rows.groupBy("context", "total").agg(
        F.sum(p * (F.log(p) - F.col("logq"))).alias("inner"), F.sum(p).alias("p"), F.sum(q).alias("q"),
        F.count("*").alias("free"), F.sum((F.col("n") - DISCOUNT) / F.col("total")).alias("taken"))
    rest = 1 - F.col("p")
    tail = F.when(rest > 1e-12, rest * F.log(F.greatest(rest, F.lit(1e-12)) / F.greatest(1 - F.col("q"), F.lit(1e-12)))).otherwise(0.0)
    states = states.filter(2 * F.col("total") * (F.col("inner") + tail) > F.col("free") + 3 * F.sqrt(2 * F.col("free"))) \
        .select("context", F.log(1 - F.col("taken")).alias("back"))
    found = rows.join(states, "context", "left").withColumn("logp", F.when(F.col("back").isNull(), F.col("logq")).otherwise(
        F.log(F.exp("back") * F.exp("logq") + (F.col("n") - DISCOUNT) / F.col("total"))))
    own = F.when(F.col("back").isNull(), 0.0).otherwise(F.col("logp") - F.col("logq") - F.col("back"))
    return found.select(_joined("context", "next").alias("key"), "short", "n", "logp", own.alias("own"),
                        "context", "total", "back")


@dataclass
class Fit:
    tree: Tree
    words: DataFrame  # all words: ``keys, counts`` of each of ``2 ** bits`` ranges
    weights: DataFrame  # length, key, own, back of what the tree does not hold
    bits: int
    tokens: int
    types: int
    levels: list[DataFrame] = field(default_factory=list)


def train(docs: DataFrame, depth: int = 3, symbol_share: float = 2e-7, local_share: float = 1e-6, least: int = 5,
          text_col: str = "text") -> Fit:
    """Learn from every row of ``docs``; null texts are empty texts, that is one end each.

    ``depth`` is the order of the model.  The shares say what is held in memory when
    scoring, sequences and single words; they change no result.
    """
    spark = docs.sparkSession
    texts, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    bits = _bits(size)
    words = write_through(_counted(docs, text_col, 0, bits, 1), "pst-0")
    total, types = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "types")]).first()
    logp = F.log((F.col("n") + 1) / F.lit(float(total + types + 1)))
    ends = [spark.range(1).select(F.lit(s).cast("long").alias("key"), F.lit(texts).cast("long").alias("n")) for s in (START, END)]
    none = F.lit(None).cast("long").alias("short")
    often = write_through(_listed(words, least).unionByName(ends[0]), "pst-often")
    shorter = often.select("key", none, "n", logp.alias("logp"))

    levels, shared = [], spark.sparkContext.broadcast(marked(often))
    for length in range(1, depth + 1):
        counts = write_through(_counted(docs, text_col, length, bits, least, shared), f"pst-counts-{length}")
        shared.destroy()
        levels.append(write_through(_settled(counts, shorter), f"pst-{length}"))
        if length < depth:
            shared = spark.sparkContext.broadcast(marked(levels[-1].select("key")))
        shorter = levels[-1].select("key", "short", "n", "logp")
    nothing = F.lit(0.0)
    ten = F.lit(float(np.log(10)))
    parts = []
    for length, level in enumerate(levels, 1):
        parts.append(level.filter("own != 0").select(F.lit(length).alias("length"), "key", "n", (F.col("own") / ten).alias("own"), nothing.alias("back")))
        states = level.filter("back IS NOT NULL").groupBy("context").agg(F.first("total"), F.first("back"))
        parts.append(states.select(F.lit(length - 1), "context", "first(total)", nothing, F.col("first(back)") / ten))
    every = reduce(lambda a, b: a.union(b), parts).groupBy("length", "key").agg(
        F.max("n").alias("n"), *[F.sum(c).alias(c) for c in ("own", "back")])
    every = write_through(every, "pst-weights")
    share = F.when(F.col("length") == 0, local_share).otherwise(symbol_share)
    hot = (F.col("n") >= share * float(max(total, 1))) & (F.col("n") > 1) | (F.col("key").isin(START, END) & (F.col("length") == 0))
    common = _listed(words, max(2.0, local_share * float(max(total, 1)))).filter(F.col("key") != END)
    common = common.unionByName(ends[1].filter("n > 0")).select(F.lit(0), "key", F.log10(F.col("n") + 1.0), nothing, nothing)
    held = every.filter(hot).select("length", "key", nothing.alias("logs"), "own", "back").union(common).groupBy("length", "key") \
        .agg(*[F.sum(c).alias(c) for c in ("logs", "own", "back")]).orderBy("length", "key").toArrow()
    length = held["length"].to_numpy()
    columns = [held[c].to_numpy() for c in ("key", "logs", "own", "back")]
    tree = Tree([Level(*[c[length == i] for c in columns]) for i in range(depth + 1)], float(np.log10(total + types + 1)),
                marked(every.filter("length > 0").select("key")))
    return Fit(tree, words, every.filter(~hot).select("length", "key", "own", "back"), bits, total, types, levels)


def _salt(length: int) -> int:
    """Tells apart keys of sequences of each length."""
    return (length * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)


def _tables(fit: Fit, bits: int) -> DataFrame:
    """Words and weights of each of ``2 ** bits`` ranges, keys in unsigned order."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                key = np.frombuffer(keys.as_buffer(), np.int64)
                used, bounds = _dealt(key, bits)
                yield _batch(bucket=used.astype(np.int32), keys=_blobs(key, bounds),
                             counts=_blobs(np.frombuffer(counts.as_buffer(), np.int64), bounds))

    def pack(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy()
        order, ends = np.argsort(key.view(np.uint64)), np.array([0, len(key)])
        return pa.table({"bucket": table["bucket"][:1], "weighed": _blobs(key[order], ends),
                         "weights": _blobs(table["weight"].to_numpy()[order], ends)})

    words = fit.words.select("bucket", "keys", "counts")
    if bits != fit.bits:
        words = fit.words.select("keys", "counts").mapInArrow(cut, "bucket int, keys binary, counts binary")
    salts = F.array(*[F.lit(_salt(i)) for i in range(len(fit.tree.levels))])
    weights = fit.weights.select(F.col("key").bitwiseXOR(F.get(salts, F.col("length"))).alias("key"), (F.col("own") + F.col("back")).alias("weight"))
    weights = weights.select(F.expr(f"cast(shiftrightunsigned(key, {64 - bits}) as int)").alias("bucket"), "key", "weight")
    packed = weights.groupBy("bucket").applyInArrow(pack, "bucket int, weighed binary, weights binary")
    return words.unionByName(packed, allowMissingColumns=True)


def score(docs: DataFrame, fit: Fit, id_col: str = "doc_id", text_col: str = "text", most: int = 1_000_000) -> DataFrame:
    """One row per row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score`` (log10).

    ``base_score`` is the add-one model of single tokens.  Null text is empty: one end.
    Null ids and repeated rows keep their row; an empty table gives an empty result;
    only id and text are read.  Words and sequences meet their weights by 64-bit hashes.

    A task's texts are cut into chunks of about ``most`` words and sequences to look up.
    These go to the ranges of their keys and what is found returns to the chunk, so both
    ways a row carries arrays.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    bits = max(fit.bits, _bits(docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]))
    shared = docs.sparkSession.sparkContext.broadcast(fit.tree)
    sums = ["words", "logs", "known", "weight"]
    salts = [np.int64(_salt(i)) for i in range(len(fit.tree.levels))]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of sums for each text, and a row of words and sequences to look up for each range."""
        tree, number = shared.value, 0
        texts, word_keys, word_places, keys, places, size = [], [], [], [], [], 0

        def spread(key: list[np.ndarray], place: list[np.ndarray]):
            """The keys by range, in each by place; the ranges and their bounds."""
            key, place = np.concatenate(key), np.concatenate(place)
            range_of = key.view(np.uint64) >> np.uint64(64 - bits)
            order = np.argsort((range_of << np.uint64(16)) | place)
            n = np.bincount(range_of.view(np.int64), minlength=1 << bits)
            used = np.flatnonzero(n)
            bounds = np.append(0, np.cumsum(n[used]))
            return key[order], _steps(place[order], bounds), used, bounds

        def out():
            ids, row, own = (pa.concat_arrays([t[0] for t in texts]), *(np.concatenate([t[i] for t in texts]) for i in (1, 2)))
            # The name of a chunk holds its rows in their order, so that what another order found never meets it.
            name = blake2b(row.tobytes() + f"{TaskContext.get().partitionId()} {number}".encode(), digest_size=8).digest()
            chunk, n = np.frombuffer(name, np.int64), len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array((row.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32)), pa.array(np.repeat(chunk, n)),
                 pa.array(np.arange(n, dtype=np.int32)), ids, *map(pa.array, own.T), *[pa.nulls(n, pa.binary())] * 4], names=names)
            for at, (key, place, used, bounds) in enumerate((spread(word_keys, word_places), spread(keys, places))):
                n = len(used)
                found = [_blobs(_short(key, bits), bounds), _blobs(place, bounds)]
                none = [pa.nulls(n, pa.binary())] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), pa.array(np.repeat(chunk, n)), pa.nulls(n, pa.int32()), pa.nulls(n, ids.type),
                     *[pa.nulls(n, pa.float64())] * 4, *(none + found if at else found + none)], names=names)

        count = 0
        for batch in pieces(batches, 1):
            for start in range(0, batch.num_rows, 1 << 15):
                piece = batch.slice(start, 1 << 15)
                length, symbol, depth = symbols(piece.column(1))
                logs, held, weight, wanted, at = tree.weighed(symbol, depth)
                text_of = np.repeat(np.arange(len(length)), length + 2)
                held &= depth > 0
                own = np.stack([length + 1.0, *(np.bincount(text_of, x, len(length)) for x in (logs, held, weight))], 1)
                texts.append((piece.column(0), piece.column(2).to_numpy(), own))
                word_keys.append(wanted[0])
                word_places.append((text_of[at[0]] + count).astype(np.uint16))
                keys.extend(key ^ salt for key, salt in zip(wanted[1:], salts[1:]))
                places.extend((text_of[x] + count).astype(np.uint16) for x in at[1:])
                count += len(length)
                size += sum(map(len, wanted))
                if size > most or count > 1 << 15:
                    yield from out()
                    texts, word_keys, word_places, keys, places, size, count, number = [], [], [], [], [], 0, 0, number + 1
        if count:
            yield from out()

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        """The rows of sums as they are; for what is looked up the text and what it adds."""
        asked, bucket = left.filter(pc.is_null(left["place"])), left["bucket"][0].as_py() if len(left) else 0
        known, counts = _flat(right["keys"], np.int64).view(np.uint64), _flat(right["counts"], np.int64)
        weighed, weights = _flat(right["weighed"], np.int64).view(np.uint64), _flat(right["weights"], np.float64)

        def of(key: str, place: str):
            keys, ends = _long(asked[key], bits, bucket).view(np.uint64), _ends(asked[key], 8 - bits // 8)
            found = _find(weighed, keys)
            return keys, _places(_flat(asked[place], np.uint16), ends), ends, np.where(found >= 0, weights[found] if len(weights) else 0.0, 0.0)

        keys, at, ends, back = of("word_keys", "word_places")
        found = _find(known, keys)
        hit = found >= 0
        ends = np.append(0, np.cumsum(hit))[ends]
        more = [_blobs(_steps(at[hit], ends), ends), _blobs(counts[found[hit]], ends), _blobs(back[hit], ends)]
        keys, at, ends, own = of("keys", "places")
        hit = own != 0
        ends = np.append(0, np.cumsum(hit))[ends]
        at, own = at[hit], own[hit]
        new = np.append(np.ones(len(at[:1]), bool), at[1:] != at[:-1])  # what a text finds in a range is added up
        new[ends[:-1][ends[:-1] < ends[1:]]] = True
        first, ends = np.flatnonzero(new), np.append(0, np.cumsum(new))[ends]
        own = np.add.reduceat(own, first) if len(first) else own
        more += [_blobs(_steps(at[first], ends), ends), _blobs(own, ends)]
        answers = pa.table({**{c: asked[c] for c in plain}, **dict(zip(blobs, more))})
        base = left.filter(pc.is_valid(left["place"])).select(plain)
        for c in blobs:
            base = base.append_column(c, pa.nulls(len(base), pa.binary()))
        return pa.concat_tables([base, answers])

    def add(table: pa.Table) -> pa.Table:
        """The sums of a chunk's texts with all that was found."""
        base = table.filter(pc.is_valid(table["place"])).sort_by("place")
        n = len(base)
        at, place = (_places(_flat(table[c], np.uint16), _ends(table[c], 2)) for c in (blobs[0], blobs[3]))
        counts, back, own = (_flat(table[c], kind) for c, kind in ((blobs[1], np.int64), (blobs[2], np.float64), (blobs[4], np.float64)))
        if n == 0 or max(at.max(initial=0), place.max(initial=0)) >= n:
            raise ValueError("the texts changed their order between two attempts of a task")
        more = {"words": 0.0, "logs": np.bincount(at, np.log10(counts + 1.0), n), "known": np.bincount(at, minlength=n),
                "weight": np.bincount(at, back, n) + np.bincount(place, own, n)}
        return pa.table({"doc_id": base["doc_id"], **{c: base[c].to_numpy() + more[c] for c in sums}})

    kind = dict(rows.dtypes)["doc_id"]
    plain = ["chunk", "place", "doc_id", *sums]
    blobs = ["known_at", "known_counts", "known_back", "found_at", "found_own"]
    own = f"chunk long, place int, doc_id {kind}, words double, logs double, known double, weight double"
    asked = ["word_keys", "word_places", "keys", "places"]
    names = ["bucket", *plain, *asked]
    found = rows.mapInArrow(local, f"bucket int, {own}, " + ", ".join(f"{c} binary" for c in asked))
    found = found.groupBy("bucket").cogroup(_tables(fit, bits).groupBy("bucket")) \
        .applyInArrow(look, f"{own}, " + ", ".join(f"{c} binary" for c in blobs))
    found = found.groupBy("chunk").applyInArrow(add, f"doc_id {kind}, " + ", ".join(f"{c} double" for c in sums))
    base = F.col("logs") - F.col("words") * F.lit(fit.tree.floor)
    return found.select(
        "doc_id", F.col("words").cast("long").alias("n_tokens"), F.round("known").cast("long").alias("n_known"),
        F.lit(fit.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("weight")).alias("score"))
