"""Remove long repeated substrings with a suffix-sorted collection.

A byte goes if a string of ``LENGTH`` bytes over it also starts elsewhere.  Strings
are first gathered where equal ones must meet: each window of ``LENGTH`` bytes names
the smallest hash among its ``GRAM``-byte pieces, so equal windows name the same key,
and runs of windows with one key form a segment.  Only segments whose key occurs
again can repeat anything; equal segments are folded into one with a count.

The segments that remain are sorted by column-wise construction of a collection's
Burrows-Wheeler transform: each round puts one symbol in front of every sequence's
suffix and inserts the new suffixes, and updates the common prefix lengths between
neighbours on the way.  Copies of the one segment of a key repeat in all their windows,
so a key without a second kind of segment needs no sorting.  A symbol is eight bytes and a segment enters once for each of
its eight alignments, so there are as many suffixes as bytes but an eighth of the rounds.  A window repeats if its suffix shares ``LENGTH`` bytes with a
neighbour, or if its segment stands for several equal ones.  Collections are bounded
in size and hold whole keys, so transform and prefix lengths stay in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole, write_through
from millrace.session import settings

LENGTH = 200
GRAM = 32
RUN = 256  # windows in a segment at most
BASE = 0x9E3779B97F4A7C15
FOLD = 16  # block of the minimum queries


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """A mixed hash of every ``gram`` bytes (a power of two), by doubling."""
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    size = 1
    while size < gram:
        h = h[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(h: np.ndarray, span: int) -> np.ndarray:
    """From running minima of blocks, forward and backward."""
    n = len(h)
    full = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = h
    blocks = full.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - span + 1], ahead[span - 1:n])


def segments(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Key, first window, number of windows, and 1 + whether the key's piece occurs at
    several places (then windows of one segment may be equal) of each segment of a text."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h, span = gram_hashes(data, gram), length - gram + 1
    key = sliding_minimum(h, span)
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    many = np.diff(np.concatenate([first, [len(key)]]))
    if many.max() > RUN:
        parts = -(-many // RUN)
        nr = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + nr * RUN
        many = np.minimum(np.repeat(many, parts) - nr * RUN, RUN)
    own, last = key[first], first + many - 1
    reach = np.arange(span)
    places = [begin + (h[begin[:, None] + reach] == own[:, None]).argmax(1) for begin in (first, last)]
    return own.view(np.int64), first, many, 1 + (places[0] != places[1])


class Minima:
    """Range minima of a byte array: blocks and a table of doubling ranges over them."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // FOLD) + 1
        padded = np.full(blocks * FOLD, 255, np.uint8)
        padded[:len(values)] = values
        self.rows = padded.reshape(blocks, FOLD)
        self.table = [self.rows.min(1)]
        while 2 << (len(self.table) - 1) <= blocks:
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over low..high of each query, both included."""
        a, b = low // FOLD, high // FOLD
        at = np.arange(FOLD)
        left = np.where((at < (low % FOLD)[:, None]) | (at + (a * FOLD)[:, None] > high[:, None]), 255, self.rows[a]).min(1)
        right = np.where((at > (high % FOLD)[:, None]) | (at + (b * FOLD)[:, None] < low[:, None]), 255, self.rows[b]).min(1)
        out = np.minimum(left, right)
        inner = np.flatnonzero(b - a > 1)
        if len(inner):
            x, y = a[inner] + 1, b[inner] - 1
            level = np.frexp((y - x + 1).astype(float))[1] - 1
            for k in np.unique(level):
                own = level == k
                table = self.table[k]
                out[inner[own]] = np.minimum(out[inner[own]], np.minimum(table[x[own]], table[y[own] - (1 << int(k)) + 1]))
        return out


def _stable_order(symbols: np.ndarray) -> np.ndarray:
    """Stable argsort, in halves of 16 bits: those numpy sorts by counting."""
    if symbols.size == 0 or symbols.max() < 1 << 16:
        return np.argsort(symbols.astype(np.uint16), kind="stable")
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((symbols >> 16).astype(np.uint16)[order], kind="stable")]


@dataclass
class Collection:
    """Symbol sequences: ``codes[last - n * step]`` is the symbol in front of a suffix of n."""

    codes: np.ndarray
    last: np.ndarray
    size: np.ndarray
    step: int

    @classmethod
    def of(cls, texts: list[bytes], step: int) -> "Collection":
        """Symbols are ``step`` bytes, numbered from 1 in byte order; a text is one
        sequence for each alignment, text by text."""
        flat = np.frombuffer(b"".join(texts) + bytes(step), np.uint8)
        words = np.zeros(len(flat) - step + 1, np.uint64)
        for k in range(step):
            words = words << np.uint64(8) | flat[k:len(flat) - step + 1 + k]
        codes = np.unique(words, return_inverse=True)[1].astype(np.uint32) + np.uint32(1)
        length = np.array([len(t) for t in texts], np.int64)
        shift = np.tile(np.arange(step), len(texts))
        size = np.maximum(np.repeat(length, step) - shift, 0) // step
        first = np.repeat(np.cumsum(length) - length, step) + shift
        return cls(codes, first + (size - 1) * step, size, step)

    def before(self, rows: np.ndarray, n: int) -> np.ndarray:
        """The symbol in front of the suffix of ``n`` symbols, 0 where there is none."""
        inside = self.size[rows] > n
        return np.where(inside, self.codes[np.where(inside, self.last[rows] - n * self.step, 0)], 0).astype(np.uint32)

    def rounds(self) -> range:
        return range(1, int(self.size.max(initial=0)) + 1)


def transform(group: Collection, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefix lengths (cut at ``most``, below 255).

    Every sequence ends in a mark of its own, smaller than all symbols and written 0;
    marks are ordered by sequence.  Round n inserts the suffixes of n symbols.
    """
    m = len(group.size)
    active = place = np.arange(m)
    symbols, prefix = group.before(active, 0), np.zeros(m, np.uint8)
    for n in group.rounds():
        going = group.size[active] >= n
        active, place = active[going], place[going]
        order = _stable_order(symbols)
        # What follows a byte in order follows it in the transform in order: the new
        # array is the marks and then all suffixes that start with a symbol.
        occurrence = order[int((symbols == 0).sum()):]
        at = np.empty(len(symbols), np.int64)
        at[occurrence] = np.arange(len(occurrence))
        new = at[place]
        old = np.ones(m + len(occurrence), bool)
        old[m + new] = False
        # Only a new suffix and the one below it get a new neighbour above.
        touched = np.zeros(len(occurrence) + 1, bool)
        touched[new] = touched[new + 1] = True
        touched = np.flatnonzero(touched[:-1])
        own = occurrence[touched]
        shared = np.zeros(len(touched), np.uint8)
        inner = np.flatnonzero(touched > 0)
        above = occurrence[touched[inner] - 1]
        alike = symbols[above] == symbols[own[inner]]
        inner, above = inner[alike], above[alike]
        if len(inner):
            below = own[inner]
            low = prefix[below]
            apart = np.flatnonzero(below - above > 1)  # most equal symbols stand next to each other
            if len(apart):
                low[apart] = Minima(prefix)(above[apart] + 1, below[apart])
            shared[inner] = np.minimum(low.astype(np.int16) + 1, most)
        place = m + new
        grown, lengths = np.zeros(len(old), np.uint32), np.zeros(len(old), np.uint8)
        grown[old], lengths[old] = symbols, prefix
        grown[place], lengths[m + touched] = group.before(active, n), shared
        symbols, prefix = grown, lengths
    return symbols, prefix


def repeated(texts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each text which of its windows occur again in the collection."""
    step = next(s for s in (8, 4, 2, 1) if length % s == 0)
    group, most = Collection.of(texts, step), length // step
    symbols, prefix = transform(group, most)
    again = prefix >= most
    again[:-1] |= prefix[1:] >= most
    order = _stable_order(symbols)
    back = np.empty(len(symbols), np.int64)  # from a suffix to the one with its symbol in front
    back[order] = np.arange(len(order)) - int((symbols == 0).sum()) + len(group.size)
    many = np.array([max(len(t) - length + 1, 0) for t in texts])
    begin = np.cumsum(many) - many
    out = np.repeat(counts > 1, many)
    active = place = np.arange(len(group.size))
    for n in group.rounds():
        going = group.size[active] >= n
        active, place = active[going], back[place[going]]
        if n >= most:
            hit = active[again[place]]
            # Sequence ``hit`` is alignment hit % step of its text; its suffix starts this far in.
            out[begin[hit // step] + hit % step + (group.size[hit] - n) * step] = True
    return np.split(out, begin[1:]) if len(texts) else []


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, after last) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _texts(batch: pa.RecordBatch, column: int, step: int = 64):
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        yield part, [(t or "").encode("utf-8", "replace") for t in part.column(column).to_pylist()]


def _segment_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part, texts in _texts(batch, 1):
                found = [segments(t, length, gram) for t in texts]
                seg = [digest(t[a:a + n + length - 1]) for t, (_, first, many, _) in zip(texts, found)
                       for a, n in zip(first.tolist(), many.tolist())]
                row = np.repeat(part.column(0).to_numpy(), [len(f[0]) for f in found])
                key, first, many, _ = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.array(seg, np.uint64).view(np.int64)), pa.array(row),
                     pa.array(first.astype(np.int32)), pa.array(many.astype(np.int32))],
                    names=["key", "seg", "row", "first", "many"])

    return rows.select("row", "text").mapInArrow(cut, "key long, seg long, row long, first int, many int")


def _key_counts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Keys whose piece occurs more than once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _texts(batch, 0, 512):
                found = [segments(t, length, gram) for t in texts]
                key, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([f[3] for f in found]), len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counted = rows.select("text").mapInArrow(cut, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("_n")).filter("_n > 1").select("key")


def _sorted(held: DataFrame, length: int, bytes_each: int) -> DataFrame:
    """``key, seg, ranges`` of the windows that repeat, from ``key, seg, n, data``."""
    total = held.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    held = held.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(max(1, total // bytes_each))))

    def sort(key, table):
        texts = table.column("data").to_pylist()
        flags = repeated(texts, table.column("n").to_numpy(), length)
        ranges = [_ranges(f) for f in flags]
        some = [i for i, r in enumerate(ranges) if r]
        return pa.table({
            "key": table.column("key").take(some), "seg": table.column("seg").take(some),
            "ranges": pa.array([[{"from": a, "to": b} for a, b in ranges[i]] for i in some],
                               pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))})

    return held.groupBy("_group").applyInArrow(sort, "key long, seg long, ranges array<struct<from:int,to:int>>")


def _by_window(held: DataFrame, length: int) -> DataFrame:
    """The same for keys with too many different segments for one collection.

    Every window is its own segment there and meets its equals by a 128-bit digest,
    counted before the shuffle; a window is held by its count alone.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(3).to_pylist()
                many = np.array([len(t) - length + 1 for t in texts])
                at = np.repeat(np.arange(len(texts)), many)
                offset = np.concatenate([np.arange(n) for n in many]) if len(many) else many
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)), part.column(2).take(pa.array(at)),
                     pa.array(offset.astype(np.int32)),
                     pa.array([digest(t[o:o + length]) for t, n in zip(texts, many.tolist()) for o in range(n)], pa.binary())],
                    names=["key", "seg", "n", "at", "window"])

    windows = write_through(held.select("key", "seg", "n", "data").mapInArrow(
        cut, "key long, seg long, n long, at int, window binary"), "repeat-windows")
    again = windows.groupBy("window").agg(F.sum("n").alias("_all")).filter("_all > 1").select("window")
    return windows.join(again, "window", "left_semi").select(
        "key", "seg", F.struct(F.col("at").alias("from"), (F.col("at") + 1).alias("to")).alias("r")) \
        .groupBy("key", "seg").agg(F.collect_list("r").alias("ranges"))


def find(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
         bytes_each: int = 1 << 16, largest: int = 1 << 14) -> DataFrame:
    """One row per row: ``doc_id, n_bytes, spans, kept_sha256``.

    ``spans`` are the maximal removed byte ranges (start, end exclusive), ``kept_sha256``
    the digest of what is left.  Matches are judged on the input and never cross
    documents; a repetition inside one document counts.  Null text is empty; texts
    shorter than ``length`` keep everything; repeated rows repeat each other and go.
    Null ids keep their row; only id and text are read; an empty table stays empty.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    twice = _key_counts(rows, length, gram)
    members = write_through(_segment_rows(rows, length, gram).join(twice, "key", "left_semi"), "repeat-segments")
    distinct = write_through(members.groupBy("key", "seg").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "first", "many")).alias("at")), "repeat-distinct")
    kinds = distinct.join(distinct.groupBy("key").agg(F.count("*").alias("_kinds")), "key")
    alone = (F.col("_kinds") == 1) & (F.col("n") > 1)
    copied = kinds.filter(alone).select("key", "seg", F.array(F.struct(F.lit(0).alias("from"), F.col("at.many").alias("to"))).alias("ranges"))
    wanted = kinds.filter(~alone).groupBy("at.row").agg(F.collect_list(F.struct("key", "seg", "n", "at.first", "at.many")).alias("parts"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, 0):
                rows = [(p["key"], p["seg"], p["n"], t[p["first"]:p["first"] + p["many"] + length - 1])
                        for t, parts in zip(texts, part.column(1).to_pylist()) for p in parts]
                key, seg, n, data = zip(*rows) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(seg, pa.int64()), pa.array(n, pa.int64()),
                                                  pa.array(data, pa.binary())], names=["key", "seg", "n", "data"])

    held = rows.join(wanted, "row").select("text", "parts").mapInArrow(fetch, "key long, seg long, n long, data binary")
    # Small batches: a row is a whole text with all its segments.
    with settings(rows.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        held = write_through(held, "repeat-data")
    per_key = held.groupBy("key").agg(F.count("*").alias("_n"))
    hot = per_key.filter(F.col("_n") > largest).select("key")
    if hot.isEmpty():
        marked = _sorted(held, length, bytes_each)
    else:
        marked = _sorted(held.join(hot, "key", "left_anti"), length, bytes_each).unionByName(
            _by_window(held.join(hot, "key", "left_semi"), length))
    marked = write_through(marked.unionByName(copied), "repeat-ranges")
    per_row = members.join(marked, ["key", "seg"]).groupBy("row").agg(
        F.collect_list(F.struct("first", "ranges")).alias("found"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, 1):
                spans, kept = [], []
                for text, found in zip(texts, part.column(2).to_pylist()):
                    gone = np.zeros(len(text) + 1, np.int32)
                    for f in found or ():
                        for r in f["ranges"]:
                            gone[f["first"] + r["from"]] += 1
                            gone[f["first"] + r["to"] - 1 + length] -= 1
                    out = _ranges(np.cumsum(gone)[:-1] > 0) if found else []
                    borders = [0, *(x for s in out for x in s), len(text)]
                    kept.append(hashlib.sha256(b"".join(text[a:b] for a, b in zip(borders[::2], borders[1::2]))).hexdigest())
                    spans.append([{"start": a, "end": b} for a, b in out])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
                    names=["doc_id", "n_bytes", "spans", "kept_sha256"])

    return rows.join(per_row, "row", "left").select("doc_id", "text", "found").mapInArrow(
        remove, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string")
