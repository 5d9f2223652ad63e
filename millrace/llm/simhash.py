"""SimHash near-duplicates through deletion variants.

A fingerprint is cut into so few segments that, of two within the distance, one
segment differs in at most one bit.  Each fingerprint is indexed under every
segment with every single bit left out, equal keys meet, and the full distance is
verified.  With distance 4 that is three segments of 21 or 22 bits instead of five
of 13, so keys are far more selective.

Only distinct fingerprints are indexed: a group of copies is one row.  What is
emitted of a key's rows is a forest and not all pairs, and a key with very many rows
is dealt out in pairs of blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from millrace.llm.common import lookup, unused, write_through
from millrace.llm.components import components

AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = 4096


def spans(text: str | None, shingle: int) -> list[bytes]:
    """All ``shingle``-word shingles in order.  Fewer words make one, no words none."""
    words = (text or "").encode("utf-8", "replace").translate(AZ).split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    return [joined[a:b] for a, b in zip(starts[:len(last)].tolist(), last.tolist())]


def fingerprint(text: str | None, shingle: int, bits: int = 64) -> bytes:
    """SimHash over ``shingle``-word shingles, repeats included, most significant byte first.

    A bit is 1 if set in over half of the shingle hashes.  Fewer words make one
    shingle; no words give all zeros.  64 bits hash with XXH64 and seed 42, longer
    fingerprints append further seeds.
    """
    parts = spans(text, shingle)
    if not parts:
        return bytes(bits // 8)
    out = b""
    for seed in range(42, 42 + bits // 64):
        digest = xxhash.xxh64_digest
        raw = np.frombuffer(b"".join([digest(s, seed) for s in parts]), np.uint8).reshape(-1, 8)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(raw), 1 << 16):
            ones += np.unpackbits(raw[at:at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
        out += np.packbits(ones * 2 > len(raw)).tobytes()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, bits: int = 64, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, row, fp`` of every row: ``row`` hashes id and text, ``fp`` is binary.

    Null text has no words; ids may be null or repeat.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    schema = StructType([rows.schema["doc_id"], rows.schema["row"], StructField("fp", BinaryType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, bits) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.binary())], names=schema.names)

    return rows.mapInArrow(mark, schema)


def segments(bits: int, distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by at most one bit."""
    count = (distance + 2) // 2
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in pairwise(edges)]


def _words(column: pa.Array, bits: int) -> np.ndarray:
    """Fixed-width binaries as rows of big-endian 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, bits // 64)


def variants(fps: DataFrame, bits: int, distance: int) -> DataFrame:
    """``key, fp``: one row per segment and bit left out.  The key holds both in its top bits."""
    cut = segments(bits, distance)
    if max(w for _, w in cut) > 44:
        raise ValueError("segments must fit a key: use a larger distance")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(start, 2048)
                spread = np.unpackbits(_words(batch.column(0), bits).astype(">u8").view(np.uint8).reshape(batch.num_rows, -1), axis=1)
                for nr, (first, size) in enumerate(cut):
                    powers = np.int64(1) << np.arange(size - 1, -1, -1, dtype=np.int64)
                    value = spread[:, first:first + size] @ powers
                    for bit in range(size):
                        name = np.int64(nr << 6 | bit) << np.int64(44)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(name | (value & ~powers[bit])), batch.column(0)], names=["key", "fp"])

    return fps.mapInArrow(index, "key long, fp binary")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for index pairs."""
    label = np.arange(max(a.max(), b.max()) + 1)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    node = np.unique(np.concatenate([a, b]))
    return node, label[node]


class Links:
    """Pairs found so far over rows of fingerprints, folded to a forest when many."""

    def __init__(self, most: int = 1 << 20):
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held, self.most = 0, most

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > self.most:
            node, root = self.forest()
            self.a, self.b, self.held = [node], [root], 0

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        return _forest(a, b) if len(a) else (a, b)


def near(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1) <= distance


def _meet(sizes: np.ndarray, first: np.ndarray, x: np.ndarray, distance: int, links: Links) -> None:
    """Compare all rows of each group (rows ``first`` on, ``sizes`` many)."""
    shift, left = 1, sizes > 1
    while left.any():
        # Row i of a group against row i + shift, over all groups that have one.
        n = sizes[left] - shift
        at = np.repeat(first[left] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        ok = near(x[at], x[at + shift], distance)
        if ok.any():
            links.add(at[ok], at[ok] + shift)
        shift += 1
        left = sizes > shift


def _linked(rows: DataFrame, bits: int, distance: int) -> DataFrame:
    """Links inside equal keys of a table clustered and sorted by key: ``a, b, key``.

    Rows with a key are the members of keys beyond ``BLOCK`` rows, put off for
    ``_in_blocks``; a task holds one batch and one key of at most that size.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), pa.array([], pa.binary())
        hot = None

        def emit(a, b, key):
            return pa.RecordBatch.from_arrays([a, b, pa.array(key, pa.int64())], names=["a", "b", "key"])

        def settle(keys, fps):
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.concatenate([start, [len(keys)]]))
            big = sizes > BLOCK
            small = (sizes > 1) & ~big
            if small.any():
                links = Links()
                _meet(sizes[small], start[small], _words(fps, bits), distance, links)
                node, root = links.forest()
                keep = node != root
                yield emit(fps.take(pa.array(node[keep])), fps.take(pa.array(root[keep])), [None] * int(keep.sum()))
            for s, n in zip(start[big].tolist(), sizes[big].tolist()):
                yield emit(fps.slice(s, n), fps.slice(s, n), keys[s:s + n])

        for batch in batches:
            more = batch.column(0).to_numpy()
            keys = np.concatenate([keys, more])
            fps = pa.concat_arrays([fps, batch.column(1)])
            if hot is not None:  # a key already put off goes on
                n = int(np.searchsorted(keys, hot, "right"))
                yield emit(fps.slice(0, n), fps.slice(0, n), keys[:n])
                keys, fps = keys[n:], fps.slice(n)
                if not len(keys):
                    continue
                hot = None
            done = int(np.searchsorted(keys, keys[-1], "left"))
            if done:
                yield from settle(keys[:done], fps.slice(0, done))
                keys, fps = keys[done:], fps.slice(done)
            if len(keys) > BLOCK:
                hot = keys[0]
                yield emit(fps, fps, keys)
                keys, fps = keys[:0], fps.slice(0, 0)
        if len(keys):
            yield from settle(keys, fps)

    return rows.mapInArrow(work, "a binary, b binary, key long")


def _in_blocks(put_off: DataFrame, bits: int, distance: int) -> DataFrame:
    """Links of keys with more than ``BLOCK`` rows: every pair of blocks is a group of its own."""
    put_off = write_through(put_off.select("key", "a"), "simhash-hot")
    number = put_off.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    rows = lookup(put_off, number, "key").withColumn("_own", F.pmod(F.xxhash64("a"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select("a", "key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))

    def meet(key, table):
        fps = table.column("a").combine_chunks()
        x, links = _words(fps, bits), Links()
        for i in range(len(x) - 1):
            ok = np.flatnonzero(near(x[i + 1:], x[i], distance)) + i + 1
            if len(ok):
                links.add(np.full(len(ok), i), ok)
        node, root = links.forest()
        return pa.table({"a": fps.take(pa.array(node)), "b": fps.take(pa.array(root))})

    return rows.groupBy("key", "_i", "_j").applyInArrow(meet, "a binary, b binary")


def link(fps: DataFrame, bits: int, distance: int) -> DataFrame:
    """``node, root`` of distinct fingerprints that have a neighbour within ``distance``."""
    distinct = write_through(fps.select("fp").distinct(), "simhash-fps")
    rows = variants(distinct, bits, distance).repartition("key").sortWithinPartitions("key")
    met = write_through(_linked(rows, bits, distance), "simhash-links")
    links = met.filter("key IS NULL").select("a", "b")
    put_off = met.filter("key IS NOT NULL")
    if not put_off.isEmpty():
        links = links.unionByName(_in_blocks(put_off, bits, distance))
    return components(links)


def near_duplicates(docs: DataFrame, shingle: int = 5, bits: int = 128, distance: int = 19,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, fp, component_id, row, stays``.

    Documents link when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest id reachable, itself included, and ``stays`` marks
    its row.  The distance alone decides, which is not a shingle similarity: 19 of 128
    bits are only expected at 0.8 (``shingles`` decides by that).  Equal fingerprints
    always link; texts without words share the zero fingerprint.  Null ids are larger
    than all others; repeated rows each keep their row and stay or go together; an
    empty table stays empty; only id and text are read.
    """
    marked = write_through(fingerprints(docs, shingle, bits, id_col, text_col), "simhash")
    root = link(marked, bits, distance)
    return settled(marked, root, "fp")


def settled(marked: DataFrame, root: DataFrame, name: str) -> DataFrame:
    """Component id and whether it stays for every row of ``marked``, by its column ``name``."""
    root = root.select(F.col("node").alias(name), F.col("root").alias("_root"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    by_fp = marked.groupBy(name).agg(F.min(first).alias("_least"))
    by_fp = lookup(by_fp, root, name).withColumn("_root", F.coalesce("_root", name))
    by_root = by_fp.groupBy("_root").agg(F.min("_least").alias("_first"))
    firsts = lookup(by_fp, by_root, "_root").select(
        name, F.col("_first.doc_id").alias("component_id"), F.col("_first.row").alias("_row"))
    return lookup(marked, firsts, name).select(
        "doc_id", name, "component_id", "row", (F.col("row") == F.col("_row")).alias("stays"))


def without(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` less the rows that do not stay."""
    name, = unused(docs, "_gone")
    gone = found.filter("NOT stays").select(F.col("row").alias(name)).distinct()
    return docs.join(gone, F.xxhash64(id_col, text_col) == F.col(name), "left_anti")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    return without(docs, near_duplicates(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)
