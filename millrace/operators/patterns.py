"""Many patterns looked for at once, each text walked once."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATTERN_BYTES = 4_000_000
PAIRS = 100_000


def _pieces(pattern: str) -> list[list[str | None]]:
    """A LIKE pattern cut at ``%``: lists of characters, None for ``_``."""
    pieces: list[list[str | None]] = [[]]
    at = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            at += 1
            if at == len(pattern) or pattern[at] not in "\\%_":
                raise ValueError(f"a backslash escapes only \\, % and _: {pattern!r}")
            pieces[-1].append(pattern[at])
        elif char == "%":
            pieces.append([])
        else:
            pieces[-1].append(None if char == "_" else char)
        at += 1
    return pieces


class Contained:
    """Tells which of the patterns a text contains, as in ``text LIKE '%' || pattern || '%'``.

    Each pattern is known to the automaton by its longest stretch of plain characters.  A hit
    decides a plain pattern; one with wildcards is then checked piece by piece.
    """

    def __init__(self, patterns: list[str]):
        self.automaton = ahocorasick.Automaton()
        self.anywhere: list[int] = []
        self.checks: list[list[re.Pattern] | None] = []
        anchors: dict[str, list[int]] = {}
        for number, pattern in enumerate(patterns):
            # The outer wildcards make the first and the last piece empty.
            pieces = [p for p in _pieces(f"%{pattern}%") if p]
            runs = ["".join(run) for p in pieces for run in self._runs(p)]
            anchor = max(runs, key=len, default="")
            plain = not pieces or (len(pieces) == 1 and None not in pieces[0])
            self.checks.append(None if plain else [self._compile(p) for p in pieces])
            if anchor:
                anchors.setdefault(anchor, []).append(number)
            else:
                self.anywhere.append(number)
        for anchor, numbers in anchors.items():
            self.automaton.add_word(anchor, tuple(numbers))
        self.automaton.make_automaton()
        self.empty = not anchors

    @staticmethod
    def _runs(piece: list[str | None]) -> Iterator[list[str]]:
        run: list[str] = []
        for char in [*piece, None]:
            if char is None:
                yield run
                run = []
            else:
                run.append(char)

    @staticmethod
    def _compile(piece: list[str | None]) -> re.Pattern:
        return re.compile("".join("." if c is None else re.escape(c) for c in piece), re.DOTALL)

    def _holds(self, number: int, text: str) -> bool:
        # The leftmost place for a piece leaves most room for the next ones.
        at = 0
        for piece in self.checks[number] or ():
            found = piece.search(text, at)
            if found is None:
                return False
            at = found.end()
        return True

    def find(self, text: str) -> list[int]:
        hits = {numbers for _, numbers in self.automaton.iter(text)} if text and not self.empty else ()
        candidates = [*self.anywhere, *(n for numbers in hits for n in numbers)]
        return [n for n in candidates if self._holds(n, text)]


_built: dict[str, Contained] = {}


def _matcher(name: str, patterns: list[str]) -> Contained:
    """The automaton of a job, built once per worker process; only the newest is kept."""
    if name not in _built:
        _built.clear()
        _built[name] = Contained(patterns)
    return _built[name]


def contained(texts: DataFrame, text_id: str, text: str, patterns: DataFrame, pattern_id: str, pattern: str) -> DataFrame:
    """Pairs (text_id, pattern_id) of non-NULL texts and the patterns they contain; texts stay where they are.

    The patterns go to all executors: the caller has checked that they are few.
    """
    spark = texts.sparkSession
    known = patterns.select(F.col(pattern_id), F.col(pattern)).filter(F.col(pattern).isNotNull()).collect()
    listed = [r[1] for r in known]
    for p in listed:
        _pieces(f"%{p}%")
    id_type = patterns.select(pattern_id).schema[0].dataType
    key = texts.select(F.col(text_id).alias("_tid")).schema[0]
    name = uuid.uuid4().hex

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, listed)
        for batch in batches:
            rows: list[int] = []
            found: list[int] = []
            for row, value in enumerate(batch.column(1).to_pylist()):
                hits = matcher.find(value)
                rows += [row] * len(hits)
                found += hits
                if len(found) >= PAIRS:
                    yield _pairs(batch, rows, found)
                    rows, found = [], []
            if found:
                yield _pairs(batch, rows, found)

    def _pairs(batch: pa.RecordBatch, rows: list[int], found: list[int]) -> pa.RecordBatch:
        ids = batch.column(0).take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int32())], names=["_tid", "_number"])

    base = texts.filter(F.col(text).isNotNull()).select(F.col(text_id).alias("_tid"), F.col(text).alias("_text"))
    pairs = base.mapInArrow(walk, T.StructType([key, T.StructField("_number", T.IntegerType())]))
    numbered = spark.createDataFrame(
        [(n, r[0]) for n, r in enumerate(known)],
        T.StructType([T.StructField("_number", T.IntegerType()), T.StructField("_pid", id_type)]),
    )
    return pairs.join(F.broadcast(numbered), "_number").select(
        F.col("_tid").alias(text_id), F.col("_pid").alias(pattern_id)
    )
