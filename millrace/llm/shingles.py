"""Near-duplicates by the exact similarity of their shingle sets, found through deletion variants.

A set of shingles has ``ROUNDS`` independent SimHash fingerprints of 128 bits.  Two sets
with a similarity of 0.8 differ in about 15 of 100 bits, so of a fingerprint's
``SEGMENTS`` segments of 16 bits one is likely to differ in at most one bit: every
segment is indexed with each of its bits left out, and equal keys meet.  Over two
fingerprints a pair at 0.8 shares a key with odds of 0.99.

Keys of 15 bits are not selective, so what meets is compared by the whole fingerprint
inside the task, in blocks and without a row per pair: all pairs of a key that are near
enough connect their rows, and a key gives a forest of them.  The connected rows of all
keys are a family.  A family's shingle sets meet once, in pairs of blocks if it is large,
and every near pair that is not connected yet is decided by its sets; connected sets form
a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from millrace.llm.common import unused, write_through
from millrace.llm.components import components
from millrace.llm.simhash import settled, spans

ROUNDS, SEGMENTS, WORDS = 2, 8, 2  # fingerprints, segments of one, 64-bit words of one
FAR = 32  # bits of 128: three deviations above the mean at a similarity of 0.8
BLOCK, SETS = 4096, 1 << 21  # rows of a key or family that meet at once, shingles of a family's block
_draw = np.random.default_rng(42)
SALT = _draw.integers(0, 1 << 63, ROUNDS * WORDS, np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The set of ``size``-word shingles as sorted 64-bit hashes; fewer words make one shingle."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 42) for s in spans(text, size)], np.uint64))


def fingerprints(own: np.ndarray) -> np.ndarray:
    """``ROUNDS * WORDS`` words: a bit is 1 if set in over half of the mixed shingle hashes."""
    ones = np.zeros(64 * len(SALT), np.int64)
    for at in range(0, len(own), 1 << 13):
        x = own[at:at + (1 << 13), None] ^ SALT
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(own)).view(np.int64)


def _marked(rows: DataFrame, size: int) -> DataFrame:
    """``doc_id, row, node, n, fp``: the set's 128-bit hash, size and fingerprints."""
    schema = StructType([rows.schema["doc_id"], rows.schema["row"], StructField("node", BinaryType()),
                         StructField("n", LongType()), StructField("fp", ArrayType(LongType()))])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 512):
                batch = whole_batch.slice(start, 512)
                node, n, fps = [], [], []
                for text in batch.column(1):
                    own = shingles(text.as_py(), size)
                    node.append(xxhash.xxh3_128_digest(own.tobytes()))
                    n.append(len(own))
                    fps.append(fingerprints(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(node, pa.binary()), pa.array(n, pa.int64()),
                     pa.array(fps, pa.list_(pa.int64()))], names=schema.names)

    return rows.mapInArrow(mark, schema)


def _variants(nodes: DataFrame, nr: int) -> DataFrame:
    """``key, id, high, low``: one row per segment of fingerprint ``nr`` and bit left out."""
    width = 64 * WORDS // SEGMENTS

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(start, 2048)
                words = [batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)]
                for segment in range(SEGMENTS):
                    first = segment * width % 64
                    value = (words[segment * width // 64] >> np.uint64(first)) & np.uint64((1 << width) - 1)
                    for bit in range(width):
                        key = (value & ~np.uint64(1 << bit)).astype(np.int64) | (segment << 8 | bit) << 32
                        yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", "id", "high", "low"])

    some = nodes.select("id", F.col("fp")[nr * WORDS].alias("high"), F.col("fp")[nr * WORDS + 1].alias("low"))
    return some.mapInArrow(index, "key long, id long, high long, low long")


def _connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Add pairs to ``label``, the smallest member of everyone's component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, new := label[label]):
            label[:] = new


def _forest(ids: np.ndarray, label: np.ndarray) -> list[pa.Array]:
    """Every id that is not its component's smallest member, after that member."""
    at = np.flatnonzero(label != np.arange(len(ids)))
    return [pa.array(ids[label[at]]), pa.array(ids[at])]


FOUND = ["a", "b", "key", "high", "low"]


def _bits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def _settle(keys: np.ndarray, ids: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A forest of the near pairs inside the equal keys of sorted rows; rows of keys beyond ``BLOCK`` are put off."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([start, [len(keys)]]))
    for s, n in zip(start[sizes > BLOCK].tolist(), sizes[sizes > BLOCK].tolist()):
        yield _put_off(keys[s:s + n], ids[s:s + n], fps[s:s + n])
    small = (sizes > 1) & (sizes <= BLOCK)
    start, sizes = start[small], sizes[small]
    if not len(start):
        return
    nodes, own = np.unique(ids, return_inverse=True)
    label, shift = np.arange(len(nodes)), 1
    while len(start):
        # Row i of a key against row i + shift, over all keys that have one.
        n = sizes - shift
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = at[label[own[at]] != label[own[at + shift]]]
        at = at[_bits(fps[at], fps[at + shift]) <= FAR]
        _connect(label, own[at], own[at + shift])
        shift += 1
        left = sizes > shift
        start, sizes = start[left], sizes[left]
    pairs = _forest(nodes, label)
    yield pa.RecordBatch.from_arrays([*pairs, *[pa.nulls(len(pairs[0]), pa.int64())] * 3], names=FOUND)


def _put_off(keys, ids, fps) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(keys),
                                       pa.array(fps[:, 0].view(np.int64)), pa.array(fps[:, 1].view(np.int64))], names=FOUND)


def _meet(rows: DataFrame) -> DataFrame:
    """``a, b`` of a table clustered and sorted by key; put-off rows have a key and no b.

    A task holds one batch and one key of at most ``BLOCK`` rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, fps = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
        hot = None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            ids = np.concatenate([ids, batch.column(1).to_numpy()])
            fps = np.concatenate([fps, np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (2, 3)], 1)])
            if hot is not None:  # a key already put off goes on
                n = int(np.searchsorted(keys, hot, "right"))
                yield _put_off(keys[:n], ids[:n], fps[:n])
                keys, ids, fps = keys[n:], ids[n:], fps[n:]
                if not len(keys):
                    continue
                hot = None
            done = int(np.searchsorted(keys, keys[-1], "left"))
            if done:
                yield from _settle(keys[:done], ids[:done], fps[:done])
                keys, ids, fps = keys[done:], ids[done:], fps[done:]
            if len(keys) > BLOCK:
                hot = keys[0]
                yield _put_off(keys, ids, fps)
                keys, ids, fps = keys[:0], ids[:0], fps[:0]
        if len(keys):
            yield from _settle(keys, ids, fps)

    return rows.mapInArrow(work, "a long, b long, key long, high long, low long")


def _in_blocks(put_off: DataFrame) -> DataFrame:
    """Forests of keys with more than ``BLOCK`` rows: every pair of blocks is a group of its own."""
    number = put_off.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    rows = put_off.join(number, "key").withColumn("_own", F.pmod(F.xxhash64("a"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select("a", "key", "high", "low", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))

    def meet(key, table):
        ids = table.column("a").to_numpy()
        order = np.argsort(ids)
        ids, fps = ids[order], np.stack([table.column(c).to_numpy()[order].view(np.uint64) for c in ("high", "low")], 1)
        label = np.arange(len(ids))
        for shift in range(1, len(ids)):
            at = np.flatnonzero(label[:-shift] != label[shift:])
            at = at[_bits(fps[at], fps[at + shift]) <= FAR]
            _connect(label, at, at + shift)
        return pa.table(dict(zip("ab", _forest(ids, label))))

    return rows.groupBy("key", "_i", "_j").applyInArrow(meet, "a long, b long")


def families(nodes: DataFrame) -> DataFrame:
    """``id, family`` of the nodes connected by pairs that share a key of any round and are near in it."""
    found = []
    for nr in range(ROUNDS):
        rows = _variants(nodes, nr).repartition("key").sortWithinPartitions("key", "id")
        met = write_through(_meet(rows), "shingle-met")
        found.append(met.filter("b IS NOT NULL").select("a", "b"))
        put_off = met.filter("b IS NULL")
        if not put_off.isEmpty():
            found.append(write_through(_in_blocks(put_off), "shingle-blocks"))
    # A row has one partner per key; it goes to the smallest of them, and so do the others, which are few kinds.
    least = F.min("a").over(Window.partitionBy("b")).alias("least")
    pairs = write_through(reduce(DataFrame.unionByName, found).distinct().select("a", "b", least), "shingle-pairs")
    pairs = pairs.select("b", F.col("least").alias("a")).unionByName(pairs.select(F.col("a").alias("b"), F.col("least").alias("a")))
    return components(pairs.distinct()).select(F.col("node").alias("id"), F.col("root").alias("family"))


def _sets(rows: DataFrame, marked: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``id, own``: the shingles of the ``wanted`` (``id, node``), worked out from the text of one of their rows."""
    some = marked.join(wanted, "node").groupBy("id").agg(F.min("row").alias("row"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 128):
                batch = whole_batch.slice(start, 128)
                own = [shingles(t.as_py(), size).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["id", "own"])

    found = rows.select("row", "text").join(some, "row").select("id", "text")
    return found.mapInArrow(work, "id long, own binary").dropDuplicates(["id"])


def _linked(fps: np.ndarray, sets: list[np.ndarray], block: np.ndarray, threshold: float) -> np.ndarray:
    """Labels of the components by all near pairs whose sets are alike; with two blocks, of pairs across them."""
    size = np.array([len(s) for s in sets])
    begin = np.cumsum(size) - size
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own, label = np.zeros(len(kinds), bool), np.arange(len(sets))
    across = block[0] != block[-1]

    def alike(row: int, some: np.ndarray) -> np.ndarray:
        n = size[some]
        first = np.cumsum(n) - n
        at = np.repeat(begin[some] - first, n) + np.arange(n.sum())
        mine = flat[begin[row]:begin[row] + size[row]]
        own[mine] = True
        common = np.add.reduceat(own[flat[at]], first, dtype=np.int64)
        own[mine] = False
        return common >= threshold * (n + size[row] - common) - 1e-9

    for row in range(1, len(sets)):
        others = label[:row] != label[row]
        if across:
            others &= block[:row] != block[row]
        others = np.flatnonzero(others)
        fit = np.minimum(size[others], size[row]) >= threshold * np.maximum(size[others], size[row]) - 1e-9
        others = others[fit]
        bits = _bits(fps[others], fps[row]).min(-1)
        others = others[np.argsort(bits, kind="stable")][:np.count_nonzero(bits <= FAR)]
        take = 1
        while len(others):  # the nearest first: a link to a component spares its other members
            some, others = others[:take], others[take:]
            some = some[alike(row, some)]
            _connect(label, some, np.full(len(some), row))
            others = others[label[others] != label[row]]
            take *= 2
    return label


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """The rows of each value of the first ``by`` columns of a table sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(by)], 1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for start, end in pairwise([0, *cut.tolist(), len(keys)]):
            if held and not np.array_equal(keys[start], last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)


def _alike(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: a forest of the links of each family (``members``: ``id, family, n, fp``).

    A family beyond ``BLOCK`` rows or ``SETS`` shingles is dealt out in blocks, and every
    pair of blocks is a group of its own.
    """
    size = members.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / SETS)).cast("int").alias("_blocks"))
    rows = members.join(size, "family").withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select("family", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "id", "fp")
    rows = rows.join(sets, "id").select("family", "_i", "_j", "_own", "id", "fp", "own")
    rows = rows.repartition("family", "_i", "_j").sortWithinPartitions("family", "_i", "_j", "_own", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            fps = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, ROUNDS, WORDS)
            own = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("own")]
            label = _linked(fps, own, table.column("_own").to_numpy(), threshold)
            yield pa.RecordBatch.from_arrays(_forest(table.column("id").to_numpy(), label), names=["a", "b"])

    return rows.mapInArrow(work, "a long, b long")


def _row(id_col: str, text_col: str):
    """128 bits that name a row by its id and text."""
    return F.struct(F.xxhash64(id_col, text_col).alias("x"), F.xxhash64(F.lit("row"), text_col, id_col).alias("y"))


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, node, component_id, row, stays``.

    Documents link when their sets of ``shingle``-word shingles share at least
    ``threshold`` of their union; equal sets always link, so do texts without words.
    ``component_id`` is the smallest id reachable, itself included, and ``stays`` marks
    its row.  Null ids are larger than all others, null texts have no words; rows that
    repeat id and text stay or go together; an empty table stays empty; only id and text
    are read.  The segments are made for a threshold of 0.8 and more.
    """
    if threshold < 0.8:
        raise ValueError("the segments are made for a similarity of 0.8 and more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", _row("doc_id", "text"))
    marked = write_through(_marked(rows, shingle), "shingle-marks")
    nodes = marked.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"))
    nodes = write_through(nodes.withColumn("id", F.monotonically_increasing_id()), "shingle-nodes")
    members = write_through(families(nodes.filter("n > 0")).join(nodes, "id"), "shingle-families")
    sets = write_through(_sets(rows, marked, members.select("id", "node"), shingle), "shingle-sets")
    root = components(_alike(members.select("id", "family", "n", "fp"), sets, threshold))
    names = nodes.select("id", "node")
    root = root.select(F.col("node").alias("id"), F.col("root").alias("_root")).join(names, "id") \
        .join(names.select(F.col("id").alias("_root"), F.col("node").alias("root")), "_root").select("node", "root")
    return settled(marked, root, "node")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    name, = unused(docs, "_gone")
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.filter("NOT stays").select(F.col("row").alias(name)).distinct()
    return docs.join(gone, _row(id_col, text_col) == F.col(name), "left_anti")
