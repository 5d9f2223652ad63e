"""Pack token sequences into as few fixed-length sequences as possible.

Documents become pieces (their ids never leave the task that made them), pieces are
dealt evenly into blocks of bounded size, and each block is packed on its own: best
fit first, then a local search that moves and exchanges pieces between underfull
sequences as long as the sum of squared fills grows, which empties sequences.
What stays underfull is dealt out anew and exchanged across the former blocks.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import unused, write_through

CAPACITY = 2048
END = np.array([0], "<u4").tobytes()


# The pre-tokenizer of byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as ranks, if its ids are in order of merging; else None."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    vocab, merges = model["model"]["vocab"], model["model"]["merges"]
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    if (model.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or model["pre_tokenizer"].get("add_prefix_space") \
            or model.get("normalizer") or any(vocab.get(j) != 256 + i for i, j in enumerate(joined)):
        return None
    letters = byte_letters()
    return {bytes(letters[c] for c in t): i for t, i in vocab.items() if i < 256 + len(joined)}


class Encoder:
    """Ids of a byte-level BPE as bytes, with a bounded memory of chunks.

    A space between two other characters always starts a new pre-token of this
    vocabulary's pattern, so a text may be encoded chunk by chunk there, and most
    chunks repeat.  New chunks go through the same vocabulary as ranks, which is
    several times faster on single words.  Texts with other white space around a
    space, or with a special token, are encoded whole.
    """

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, bytes] = {"": b""}
        self.chunk = None
        if ranks := merge_ranks(path):
            import tiktoken

            self.chunk = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.chunk is None or "\0" in text or any(s in text for s in self.special):
            return self.plain(text)
        chunks = text.replace(" ", "\0 ").split("\0")
        ids = list(map(self.known.get, chunks))
        if None not in ids:
            return b"".join(ids)
        found: dict[str, bytes] = {}
        for i, value in enumerate(ids):
            if value is None:
                c = chunks[i]
                value = found.get(c)
                if value is None:
                    if c[0].isspace() and (c[0] != " " or len(c) < 2 or c[1].isspace()) or c[-1].isspace():
                        return self.plain(text)
                    value = found[c] = array("I", self.chunk(c)).tobytes()
                ids[i] = value
        if len(self.known) + len(found) <= self.most:
            self.known.update(found)
        return b"".join(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (uint32 bytes).

    Each document is its ids and then id 0, so an empty or null text is one piece of
    length 1.  Null ids and repeated rows keep their pieces; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [rows.schema["doc_id"]] + [StructField(n, LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    schema = StructType(fields)
    if with_ids:
        schema = schema.add("ids", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            at, out, raw = [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + END
                for nr, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    part = ids[4 * start: 4 * (start + length)]
                    at.append(row)
                    out.append((nr, start, length, zlib.crc32(part)))
                    if with_ids:
                        raw.append(part)
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([],) * 4)]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(cut, schema)


class Bins:
    """Sequences of one block; underfull ones are indexed by the lengths they hold."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self.holds: dict[int, set[int]] = defaultdict(set)  # length -> underfull bins with it
        self.lengths = 0  # bit l: holds[l] is not empty

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room."""
        open_at: dict[int, list[int]] = defaultdict(list)
        rooms = 0
        for i in sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i]):
            size = self.sizes[i]
            fits = rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = open_at[room].pop()
                if not open_at[room]:
                    rooms &= ~(1 << room)
            else:
                room, b = self.capacity, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[b].append(i)
            self.fill[b] += size
            if room > size:
                open_at[room - size].append(b)
                rooms |= 1 << (room - size)

    def adopt(self, at: list[int]) -> None:
        """Take over bins numbered from 0."""
        self.items = [[] for _ in range(max(at, default=-1) + 1)]
        self.fill = [0] * len(self.items)
        for i, b in enumerate(at):
            self.items[b].append(i)
            self.fill[b] += self.sizes[i]

    def index(self, b: int) -> None:
        if 0 < self.fill[b] < self.capacity:
            for i in self.items[b]:
                self.holds[self.sizes[i]].add(b)
                self.lengths |= 1 << self.sizes[i]

    def unindex(self, b: int) -> None:
        for i in self.items[b]:
            size = self.sizes[i]
            self.holds[size].discard(b)
            if not self.holds[size]:
                self.lengths &= ~(1 << size)

    def lender(self, b: int, low: int, high: int, given: int) -> tuple[int, int] | None:
        """The longest piece of low..high, and its bin, that ``b`` gains by taking for ``given``."""
        window = (self.lengths >> low & ((1 << (high - low + 1)) - 1)) if high >= low else 0
        while window:
            size = low + window.bit_length() - 1
            for a in self.holds[size]:
                if a != b and self.fill[a] < self.fill[b] + size - given:
                    return size, a
            window &= ~(1 << (size - low))
        return None

    def trade(self, b: int, give: list[int], a: int, take: list[int]) -> None:
        self.unindex(a)
        self.unindex(b)
        for i in give:
            self.items[b].remove(i)
        for i in take:
            self.items[a].remove(i)
        self.items[b] += take
        self.items[a] += give
        shift = sum(self.sizes[i] for i in take) - sum(self.sizes[i] for i in give)
        self.fill[b] += shift
        self.fill[a] -= shift
        self.index(a)
        self.index(b)
        self.traded.add(a)

    def piece(self, a: int, size: int) -> int:
        return next(i for i in self.items[a] if self.sizes[i] == size)

    def improve(self, b: int) -> bool:
        """One move or exchange that makes ``b`` fuller and the sum of squares larger."""
        room = self.capacity - self.fill[b]
        if not 0 < room < self.capacity:
            return False
        if got := self.lender(b, 1, room, 0):  # move
            self.trade(b, [], got[1], [self.piece(got[1], got[0])])
            return True
        own = {self.sizes[i]: i for i in self.items[b]}
        for size, i in own.items():  # one for one
            if got := self.lender(b, size + 1, min(size + room, self.capacity), size):
                self.trade(b, [i], got[1], [self.piece(got[1], got[0])])
                return True
        # Distinct lengths are few (63 fill 2,048), however many pieces there are.
        twice = {self.sizes[i]: [own[self.sizes[i]], i] for i in self.items[b] if own[self.sizes[i]] != i}
        pairs = {x + y: [own[x], own[y]] for x, y in combinations(own, 2)} | {2 * x: both for x, both in twice.items()}
        for size, both in pairs.items():  # two of this bin for one
            if got := self.lender(b, size + 1, min(size + room, self.capacity), size):
                self.trade(b, both, got[1], [self.piece(got[1], got[0])])
                return True
        for size, i in own.items():  # one of this bin for two of another, of lengths first >= second
            most = size + room
            firsts = self.lengths & ((1 << most) - 1)
            while firsts:
                first = firsts.bit_length() - 1
                firsts &= ~(1 << first)
                if 2 * first <= size:
                    break
                for a in self.holds[first]:
                    if a == b or self.fill[a] >= self.fill[b] + room:
                        continue
                    x = self.piece(a, first)
                    for y in self.items[a]:
                        gain = first + self.sizes[y] - size
                        if y != x and 0 < gain <= room and self.fill[a] < self.fill[b] + gain:
                            self.trade(b, [i], a, [x, y])
                            return True
        return False

    def search(self) -> None:
        """Fullest bins first; one that found nothing is tried again once it has traded."""
        for b in range(len(self.items)):
            self.index(b)
        self.traded = {b for b in range(len(self.items)) if 0 < self.fill[b] < self.capacity}
        while self.traded:
            due, self.traded = sorted(self.traded, key=lambda b: -self.fill[b]), set()
            for b in due:
                while self.improve(b):
                    pass


def pack_block(sizes: list[int], capacity: int, start: list[int] | None = None) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the fill of its bin; ``start`` gives bins to improve."""
    bins = Bins(sizes, capacity)
    if start is None:
        bins.best_fit()
    else:
        bins.adopt(start)
    bins.search()
    at, offset = [0] * len(sizes), [0] * len(sizes)
    for b, own in enumerate(bins.items):
        place = 0
        for i in own:
            at[i], offset[i] = b, place
            place += sizes[i]
    return at, offset, [bins.fill[b] for b in at]


def pack(parts: DataFrame, capacity: int = CAPACITY, block: int = 25_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table with ``length`` (1 to ``capacity``).

    Pieces are dealt by their place in the written table, so repeated rows spread as
    well.  Sequences that stay underfull are dealt out anew, whole, and exchange with those of
    other blocks, as long as their free room would make a sequence and their pieces halve from
    round to round; a round never adds a sequence.  An empty table stays empty; other columns
    come through unchanged.
    """
    parts = write_through(parts, "pieces")
    dealt_to, fill = unused(parts, "_block", "_fill")
    count = parts.count()
    blocks = max(1, -(-count // block))
    fields = [*parts.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    schema = StructType([*fields, StructField(fill, LongType())])
    given = parts.columns

    def placed(table, ids, offset, full):
        added = zip(("sequence_id", "offset", fill), (ids, offset, full))
        table = table.select(given)
        for name, values in added:
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    def place(key, table):
        at, offset, full = pack_block(table.column("length").to_pylist(), capacity)
        return placed(table, (np.int64(key[0].as_py()) << np.int64(32)) | np.array(at, np.int64), offset, full)

    def exchange(key, table):
        known, start = np.unique(table.column("sequence_id").to_numpy(), return_inverse=True)
        at, offset, full = pack_block(table.column("length").to_pylist(), capacity, start.tolist())
        return placed(table, known[at], offset, full)

    dealt = parts.withColumn(dealt_to, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    packed = dealt.groupBy(dealt_to).applyInArrow(place, schema)
    done, nr = [], 0
    while blocks > 1:
        packed = write_through(packed, "packed")
        nr += 1
        room = F.sum(F.when(F.col("offset") == 0, F.lit(capacity) - F.col(fill)))
        left, free = packed.filter(F.col(fill) < capacity).agg(F.count("*"), room).first()
        if left == 0 or free < capacity or (nr > 1 and 2 * left > count):
            break
        done.append(packed.filter(F.col(fill) == capacity))
        count, blocks = left, max(1, -(-left // block))
        dealt = packed.filter(F.col(fill) < capacity).withColumn(
            dealt_to, F.pmod(F.xxhash64(F.lit(nr), "sequence_id"), F.lit(blocks)))
        packed = dealt.groupBy(dealt_to).applyInArrow(exchange, schema)
    return reduce(DataFrame.unionByName, [*done, packed]).drop(fill)
