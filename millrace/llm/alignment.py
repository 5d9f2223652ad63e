"""Alignment of two tokenizers, with the corpus-wide count of every linked pair of ids.

Both tokenizers cut the same bytes.  Offsets where both end a token cut a text into
groups, and two tokens are linked where their bytes overlap.  How many documents hold a
pair linked is counted in two passes over the documents:

1. Every task aligns its documents and counts its own distinct pairs.  All distinct
   pairs, split into buckets, get a minimal perfect hash per bucket.  A task's counts
   become dense vectors indexed by that hash, and the vectors of all tasks are summed as
   a tree, sixteen at a time.
2. The documents are aligned again, each pair is looked up by its hash, and the key
   stored there is compared with it.

The lookup table is the only thing broadcast.  It holds at most ``PAIRS`` pairs; more
are looked up in several passes of that size, whose sums are added up.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm.common import write_through
from millrace.llm.packing import byte_letters

PAIRS = 16_000_000  # pairs of one lookup table: 8 bytes and a few bits each
PER_BUCKET = 1 << 16
FAN_IN = 16
KNOWN = 600_000  # chunks a Python worker remembers
HELD = 2_000_000  # pairs a task counts before it hands them on
# A space between two other characters starts a new token in both tokenizers.
BORDER = re.compile(r"(?<=\S)(?= \S)")
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


# ------------------------------------------------------------ minimal perfect hash

def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits per key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def spread(keys: np.ndarray) -> np.ndarray:
    """What a pair's bucket is taken from."""
    return (mix(keys, 1000) >> np.uint64(33)).astype(np.int64)


@dataclass
class PerfectHash:
    """Levels of bits: a key stands at the first level where no other key shared its place.

    A key's number is how many bits are set before its own, so n keys get 0 to n - 1.
    """

    bits: list[np.ndarray]  # 64-bit words per level
    before: list[np.ndarray]  # set bits before each word, over all levels

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        bits, left, level = [], keys, 0
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            place = (mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            left, level = left[~alone[place]], level + 1
        return PerfectHash.of(bits)

    @staticmethod
    def of(bits: list[np.ndarray]) -> "PerfectHash":
        before, total = [], 0
        for words in bits:
            upto = np.cumsum(np.bitwise_count(words), dtype=np.int64) + total
            before.append(np.concatenate([[total], upto[:-1]]))
            total = int(upto[-1])
        return PerfectHash(bits, before)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it surely is none of the built ones."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, words in enumerate(self.bits):
            if not len(left):
                break
            place = (mix(keys[left], level) % np.uint64(64 * len(words))).astype(np.int64)
            word, bit = words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = self.before[level][place[hit] >> 6] + below[hit]
            left = left[~hit]
        return out

    def pack(self) -> bytes:
        head = np.array([len(self.bits), *map(len, self.bits)], "<u8")
        return head.tobytes() + b"".join(b.tobytes() for b in self.bits)

    @staticmethod
    def unpack(data: bytes) -> "PerfectHash":
        words = np.frombuffer(data, "<u8")
        levels = int(words[0])
        ends = np.cumsum(words[1:levels + 1].astype(np.int64)) + levels + 1
        return PerfectHash.of([words[e - n:e] for e, n in zip(ends.tolist(), words[1:levels + 1].tolist())])


class Lookup:
    """Counts of the pairs of some buckets; pairs of other buckets count 0."""

    def __init__(self, buckets: int, rows: list, best: np.ndarray, size_b: int):
        self.buckets, self.best, self.size_b = buckets, best, size_b
        self.tables = {r[0]: (PerfectHash.unpack(r[1]), np.frombuffer(r[2], "<u4" if r[4] else "<i8"),
                              np.frombuffer(r[3], "<u4" if r[5] else "<i8")) for r in rows}

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents that hold the pair, 1 if no pair of its A id is held by more)."""
        counts = np.zeros(len(pairs), np.int64)
        own, back = np.unique(pairs, return_inverse=True)
        bucket, found = spread(own) % self.buckets, np.zeros(len(own), np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for part in np.split(order, starts[1:]) if len(order) else ():
            table = self.tables.get(int(bucket[part[0]]))
            if table is None:
                continue
            numbers = table[0].number(own[part])
            known = (numbers >= 0) & (numbers < len(table[1]))
            at = numbers[known]
            right = table[1][at].astype(np.int64) == own[part][known]  # the stored key decides
            found[part[known][right]] = table[2][at[right]]
        counts[:] = found[back]
        return counts, ((counts > 0) & (counts == self.best[pairs // self.size_b])).astype(np.int64)


# ------------------------------------------------------------ aligning chunks

class Tokenizers:
    """Both tokenizers and the bytes of all their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = ([str(i) for i in range(len(table))] for table in (self.bytes_a, self.bytes_b))
        # Only if no piece goes on behind a space may a text be cut before spaces.
        self.cuts = not any(" " in self.b.id_to_piece(i).replace("▁", " ").lstrip(" ") for i in range(self.b.vocab_size()))

    def chunks(self, text: str) -> list[str]:
        """Space and text, cut where both tokenizers always begin a token."""
        return BORDER.split(" " + text) if self.cuts else [" " + text]

    def encode_a(self, chunks: list[str], plain: int) -> np.ndarray:
        """Ids of all chunks, end to end, by the first tokenizer.  It begins a token at each of the
        first ``plain`` chunks, so they go through it 64 at once."""
        rows = ["".join(chunks[at:min(at + 64, plain)]) for at in range(0, plain, 64)] + chunks[plain:]
        found = self.a.encode_batch_fast(rows, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(f.ids for f in found), np.int64)

    def encode_b(self, chunks: list[str]) -> list[list[int]]:
        """Ids by the second tokenizer, which adds the leading space itself."""
        return self.b.encode([c[1:] for c in chunks], num_threads=1)


class Aligned:
    """Facts of some chunks, with the links of all of them in one array.

    All chunks are laid end to end.  Both tokenizers end a token at each chunk's end, so
    one sorted list of byte offsets gives the links and the groups of all chunks at once:
    every stretch between two offsets lies in one token of each.
    """

    def __init__(self, both: Tokenizers, chunks: list[str], plain: int, with_groups: bool):
        flat_a, ids_b = both.encode_a(chunks, plain), both.encode_b(chunks)
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64)
        own = [c.encode("utf-8", "replace") for c in chunks]
        good = np.ones(len(chunks), bool)
        whole = b"".join(own)
        if b"".join([both.bytes_a[i] for i in flat_a.tolist()]) != whole or b"".join([both.bytes_b[i] for i in flat_b.tolist()]) != whole \
                or not (both.size_a[flat_a].all() and both.size_b[flat_b].all() and all(ids_b)):
            ids_a = [both.encode_a([c], 0) for c in chunks]
            for at, (x, y, part) in enumerate(zip(ids_a, ids_b, own)):
                good[at] = (b"".join([both.bytes_a[i] for i in x]) == part == b"".join([both.bytes_b[i] for i in y])
                            and len(x) > 0 and bool(both.size_a[x].all() and both.size_b[y].all()))
            flat_a = np.concatenate([*[x for x, ok in zip(ids_a, good) if ok], np.zeros(0, np.int64)])
            flat_b = np.fromiter(chain.from_iterable(y for y, ok in zip(ids_b, good) if ok), np.int64)
        ends_a, ends_b = np.cumsum(both.size_a[flat_a]), np.cumsum(both.size_b[flat_b])
        last = np.cumsum([len(p) if ok else 0 for p, ok in zip(own, good)], dtype=np.int64)
        offsets = np.union1d(ends_a, ends_b)
        self.links = flat_a[np.searchsorted(ends_a, offsets)] * len(both.bytes_b) + flat_b[np.searchsorted(ends_b, offsets)]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)

        def per_chunk(ends: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(ends, last, "right"), prepend=0)

        n_groups, n_links = per_chunk(cuts), per_chunk(offsets)
        self.facts = np.stack([per_chunk(ends_a), per_chunk(ends_b), n_groups, n_links, ~good], 1).astype(np.int64)
        self.groups: list[str] = []
        if with_groups:
            names_a, names_b = [both.name_a[i] for i in flat_a.tolist()], [both.name_b[i] for i in flat_b.tolist()]
            upto_a, upto_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
            parts, i, j = [], 0, 0
            for x, y in zip(upto_a.tolist(), upto_b.tolist()):
                parts.append(f"{names_a[i]}|{names_b[j]}" if x == i + 1 and y == j + 1 else ",".join(names_a[i:x]) + "|" + ",".join(names_b[j:y]))
                i, j = x, y
            upto = np.cumsum(n_groups).tolist()
            self.groups = [";".join(parts[x:y]) for x, y in zip([0, *upto], upto)]


class Known:
    """Chunks aligned so far in this worker; the first ``KNOWN`` of them stay for later tasks.

    A text is split at every space.  Pieces that are empty or have white space at an end
    show that a space there is no border; such a text is cut by the rule itself.
    """

    def __init__(self, both: Tokenizers, with_groups: bool):
        self.both, self.with_groups = both, with_groups
        self.number: dict[str, int] = {}
        self.facts, self.links = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)
        self.starts, self.groups = np.zeros(0, np.int64), []
        self.scored, self.scores = None, np.zeros((0, 2), np.int64)

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """The numbers of each text's chunks in order, none for null and empty texts."""
        get, words, odd = self.number.get, {}, {}  # chunks not met before, in order
        chunked, found = [], []
        for text in texts:
            own = text.split(" ") if text else []
            ids = list(map(get, own))
            missing = [w for w, i in zip(own, ids) if i is None] if None in ids else []
            if own and not (self.both.cuts and all(w and not w[0].isspace() and not w[-1].isspace() for w in missing)):
                # A piece with an odd border is named with its leading space.
                own = [c if " " in c[1:] or c[1:2].isspace() or c[-1:].isspace() else c[1:] for c in self.both.chunks(text)]
                ids = list(map(get, own))
                odd.update((c, None) for c, i in zip(own, ids) if i is None and c[0] == " ")
                missing = [c for c, i in zip(own, ids) if i is None and c[0] != " "]
            words.update(dict.fromkeys(missing))
            chunked.append(own)
            found.append(ids)
        if words or odd:
            aligned = Aligned(self.both, [*[" " + w for w in words], *odd], len(words) if self.both.cuts else 0, self.with_groups)
            for at, chunk in enumerate([*words, *odd], len(self.number)):
                self.number[chunk] = at
            sizes = aligned.facts[:, 3]
            self.starts = np.concatenate([self.starts, len(self.links) + np.cumsum(sizes) - sizes])
            self.links, self.facts = np.concatenate([self.links, aligned.links]), np.concatenate([self.facts, aligned.facts])
            self.groups += aligned.groups
        number = self.number
        return [[number[c] if i is None else i for c, i in zip(own, ids)] if None in ids else ids for own, ids in zip(chunked, found)]

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all links of these chunks, how many each has)."""
        sizes = self.facts[numbers, 3]
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.links[np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes

    def values(self, look: "Lookup", name: str) -> np.ndarray:
        """``FIELDS`` of all chunks, and last whether their bytes differ."""
        if self.scored != name:
            self.scored, self.scores = name, self.scores[:0]
        done = len(self.scores)
        if done < len(self.facts):
            pairs, sizes = self.links_of(np.arange(done, len(self.facts)))
            upto = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(part)]) for part in reversed(look(pairs))]
            self.scores = np.concatenate([self.scores, np.stack([total[upto[1:]] - total[upto[:-1]] for total in sums], 1)])
        return np.concatenate([self.facts[:, :4], self.scores, self.facts[:, 4:]], 1)

    def forget(self) -> None:
        """Keep the first ``KNOWN`` chunks only."""
        if len(self.number) > KNOWN:
            while len(self.number) > KNOWN:
                self.number.popitem()
            self.links = self.links[:self.starts[KNOWN]]
            self.starts, self.facts, self.scores = self.starts[:KNOWN], self.facts[:KNOWN], self.scores[:KNOWN]
            del self.groups[KNOWN:]


_loaded: dict[tuple[str, str], Tokenizers] = {}
_known: dict[tuple[str, str, bool], Known] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair per Python worker."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Tokenizers(path_a, path_b)
    return _loaded[path_a, path_b]


def known(path_a: str, path_b: str, with_groups: bool) -> Known:
    """One per Python worker."""
    key = (path_a, path_b, with_groups)
    if key not in _known:
        _known[key] = Known(tokenizers(path_a, path_b), with_groups)
    return _known[key]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# ------------------------------------------------------------ first pass: counts

def _summed(pairs: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    own, back = np.unique(np.concatenate(pairs), return_inverse=True)
    out = np.zeros(len(own), np.int64)
    np.add.at(out, back, np.concatenate(numbers))
    return own, out


def tally(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """``pair, n, spread, part``: in how many documents of a task a pair is linked.

    A task hands its counts on when it holds ``HELD`` pairs, so a pair may come several times.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = known(path_a, path_b, False)
        pairs, numbers, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def out(own, counts):
            for at in range(0, len(own), 1 << 16):
                some = own[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[at:at + (1 << 16)]), pa.array(spread(some))],
                                                 names=["pair", "n", "spread"])

        for batch in _slices(batches):
            found = store.numbers(batch.column(0).to_pylist())
            chunks = np.array([i for own in found for i in own], np.int64)
            doc = np.repeat(np.arange(len(found)), [len(own) for own in found])
            bad = np.bincount(doc, store.facts[chunks, 4], len(found))[doc] > 0
            linked, sizes = store.links_of(chunks[~bad])
            # Each pair once per document: ids of both vocabularies fit 44 bits.
            every = np.sort(np.repeat(doc[~bad], sizes) << 44 | linked)
            once = np.sort(every[np.diff(every, prepend=-1) > 0] & (1 << 44) - 1)
            first = np.flatnonzero(np.diff(once, prepend=-1))
            own, counts = once[first], np.diff(first, append=len(once))
            pairs.append(own)
            numbers.append(counts)
            held += len(own)
            if held > HELD:
                own, counts = _summed(pairs, numbers)
                if len(own) > HELD // 2:
                    yield from out(own, counts)
                    own, counts = own[:0], counts[:0]
                pairs, numbers, held = [own], [counts], len(own)
            store.forget()
        yield from out(*_summed(pairs, numbers))

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(work, "pair long, n long, spread long")
    return rows.withColumn("part", F.spark_partition_id())


@dataclass
class Counted:
    """The counted pairs: ``table`` has one row per bucket, ``best`` the highest count per A id."""

    table: DataFrame  # bucket, hash, keys, counts, narrow_keys, narrow_counts, n
    buckets: int
    pairs: int
    best: np.ndarray
    size_b: int


def count_pairs(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", per_bucket: int = PER_BUCKET) -> Counted:
    """Distinct pairs, their perfect hashes and their counts summed over all tasks."""
    both = tokenizers(path_a, path_b)
    size_a, size_b = len(both.bytes_a), len(both.bytes_b)
    narrow = size_a * size_b <= 1 << 32
    parts = write_through(tally(docs, path_a, path_b, text_col), "pair-counts")
    distinct = write_through(parts.select("pair", "spread").distinct(), "pairs")
    pairs = distinct.count()
    buckets = max(1, -(-pairs // per_bucket))
    bucket = (F.col("spread") % buckets).alias("bucket")

    def build(key, table):
        keys = np.sort(table.column("pair").to_numpy())
        hashed = PerfectHash.build(keys)
        placed = np.empty_like(keys)
        placed[hashed.number(keys)] = keys
        return pa.table({"bucket": [key[0].as_py()], "hash": [hashed.pack()], "keys": [placed.astype("<u4" if narrow else "<i8").tobytes()]})

    hashes = write_through(distinct.select(bucket, "pair").groupBy("bucket").applyInArrow(build, "bucket long, hash binary, keys binary"),
                           "pair-hashes")
    width = (parts.agg(F.max("part")).first()[0] or 0) + 1

    def index(key, own, table):
        hashed = PerfectHash.unpack(table.column("hash")[0].as_py())
        size = len(table.column("keys")[0].as_py()) // (4 if narrow else 8)
        vector = np.zeros(size, np.int64)
        np.add.at(vector, hashed.number(own.column("pair").to_numpy()), own.column("n").to_numpy())
        return pa.table({"bucket": [key[0].as_py()], "twig": [key[1].as_py()], "counts": [vector.tobytes()]})

    def add(key, table):
        vectors = (np.frombuffer(v.as_py(), np.int64) for v in table.column("counts"))
        return pa.table({"bucket": [key[0].as_py()], "twig": [key[1].as_py()], "counts": [reduce(np.add, vectors).tobytes()]})

    schema = "bucket long, twig long, counts binary"
    own = parts.select(bucket, (F.col("part") / FAN_IN).cast("long").alias("twig"), "pair", "n")
    width = -(-width // FAN_IN)
    everywhere = hashes.withColumn("twig", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    vectors = own.groupBy("bucket", "twig").cogroup(everywhere.groupBy("bucket", "twig")).applyInArrow(index, schema)
    while width > 1:
        vectors = vectors.withColumn("twig", (F.col("twig") / FAN_IN).cast("long")).groupBy("bucket", "twig").applyInArrow(add, schema)
        width = -(-width // FAN_IN)
    table = write_through(hashes.join(vectors.select("bucket", "counts"), "bucket"), "pair-table")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(keys.as_py(), "<u4" if narrow else "<i8").astype(np.int64) // size_b
                high = np.zeros(size_a, np.int64)
                np.maximum.at(high, ids, np.frombuffer(counts.as_py(), np.int64))
                used = np.flatnonzero(high)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(high[used])], names=["a", "n"])

    # At most one row per id of the first vocabulary.
    top = table.select("keys", "counts").mapInArrow(finish, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).toArrow()
    best = np.zeros(size_a, np.int64)
    best[top.column("a").to_numpy()] = top.column("n").to_numpy()
    return Counted(table, buckets, pairs, best, size_b)


# ------------------------------------------------------------ second pass: lookup

def _narrowed(counts: bytes) -> tuple[bytes, bool]:
    values = np.frombuffer(counts, np.int64)
    small = not len(values) or int(values.max()) < 1 << 32
    return (values.astype("<u4").tobytes() if small else counts), small


def _looked_up(rows: DataFrame, kept: list[str], found: Lookup, path_a: str, path_b: str) -> DataFrame:
    """``kept`` columns of ``rows`` (text last) with ``FIELDS`` and ``groups_sha256``."""
    schema = StructType([rows.schema[c] for c in kept] + [StructField(f, LongType()) for f in FIELDS] + [StructField("groups_sha256", StringType())])
    shared, name = rows.sparkSession.sparkContext.broadcast(found), uuid.uuid4().hex  # at most PAIRS pairs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, look = known(path_a, path_b, True), shared.value
        for batch in _slices(batches):
            found = store.numbers(batch.column(batch.num_columns - 1).to_pylist())
            values = store.values(look, name)
            sums = np.concatenate([np.zeros((1, values.shape[1]), np.int64), values[[i for own in found for i in own]].cumsum(0)])
            upto = np.concatenate([[0], np.cumsum([len(own) for own in found], dtype=np.int64)])
            out = sums[upto[1:]] - sums[upto[:-1]]
            good = (out[:, -1] == 0) & (upto[1:] > upto[:-1])  # else no text, or bytes that are not the text's
            out[~good] = 0
            digests = [hashlib.sha256(";".join([store.groups[i] for i in own]).encode()).hexdigest() if ok else ""
                       for own, ok in zip(found, good.tolist())]
            store.forget()
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [pa.array(out[:, i]) for i in range(len(FIELDS))]
                                             + [pa.array(digests)], names=schema.names)

    return rows.select(*kept, "text").mapInArrow(work, schema)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          most: int = PAIRS, per_bucket: int = PER_BUCKET) -> DataFrame:
    """One row per row: ``doc_id``, the numbers of ``FIELDS`` and ``groups_sha256``.

    Null and empty texts, and texts whose tokens' bytes are not space and text, have no
    tokens: zeros and an empty digest.  Null ids and repeated rows keep their row and
    count as documents of their own; only id and text are read; an empty table gives an
    empty result.  More than ``most`` distinct pairs are looked up in several passes.
    """
    counted = count_pairs(docs, path_a, path_b, text_col, per_bucket)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    passes = max(1, -(-counted.pairs // most))
    step = -(-counted.buckets // passes)
    kept = ["doc_id"]
    if passes > 1:  # rows need a number to add their parts up by
        rows = write_through(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        kept = ["doc_id", "_row"]
    parts = []
    for first in range(0, counted.buckets, step):
        some = counted.table.filter((F.col("bucket") >= first) & (F.col("bucket") < first + step)).select("bucket", "hash", "keys", "counts")
        narrow = len(counted.best) * counted.size_b <= 1 << 32
        table = [(r["bucket"], bytes(r["hash"]), bytes(r["keys"]), *_row(r, narrow)) for r in some.toLocalIterator()]
        found = Lookup(counted.buckets, table, counted.best, counted.size_b)
        part = _looked_up(rows, kept, found, path_a, path_b)
        parts.append(part if passes == 1 else write_through(part, "looked-up"))
    if passes == 1:
        return parts[0]
    whole = reduce(DataFrame.unionByName, parts)
    same = [F.first(c).alias(c) for c in ("doc_id", *FIELDS[:4], "groups_sha256")]
    summed = whole.groupBy("_row").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return summed.select("doc_id", *FIELDS, "groups_sha256")


def _row(r, narrow: bool) -> tuple:
    counts, small = _narrowed(bytes(r["counts"]))
    return counts, narrow, small
