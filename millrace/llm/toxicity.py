"""Toxicity from two Kneser-Ney language models.

One word-bigram model learns from toxic texts, one from ordinary texts.  Words that
are rare in a class fall back to continuation counts both classes share, so a rare
word says nothing about the class; an expression that one class uses does.  The
log-likelihood ratio of the toxic expressions, divided by the length, is mapped to 0..1
by a logistic curve fitted on labelled texts the counts have not seen.  Words below
``Model.least`` count nothing: where the classes differ by little, they differ by
their mix of languages and topics, and in a long text that would outweigh an insult.
A pair counts once per text and equal texts count once, so copies do not make a word toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import write_through

TOXIC, ORDINARY = 1, 0
START, STEM, HEAD = b"\x00", b"\x01", 6  # marks that are no word; bytes of a word's beginning
# Letters, digits and all non-ASCII bytes make words; A-Z are lower-cased.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c >= 128 or c == 39 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TABLE).split()


@dataclass
class Model:
    """Arrays by word number (0: unknown) and by pair, sorted by key."""

    number: dict[bytes, int]
    single: np.ndarray  # class x word: probability without context
    back: np.ndarray  # class x word: weight of ``single`` after this word
    pairs: np.ndarray  # first * words + second
    extra: np.ndarray  # class x pair: discounted share of the pair
    curve: np.ndarray  # intercept, slopes
    least: float = 2.5  # words less toxic than by this log factor count nothing

    def ratios(self, texts: list[str | None]) -> np.ndarray:
        """Two columns per text: log-likelihood ratio per word and per root of the words."""
        tokens = [words(t) for t in texts]
        size = np.array([len(t) for t in tokens])
        get = self.number.get
        ids = np.array([get(w) or get(STEM + w[:HEAD], 0) for t in tokens for w in (START, *t)], np.int64)
        at = np.cumsum(size + 1) - size  # place of each first word
        inner = np.ones(len(ids), bool)
        inner[at - 1] = False
        place = np.flatnonzero(inner)
        first, second = ids[place - 1], ids[place]
        p = self.back[:, first] * self.single[:, second]
        if len(self.pairs):
            key = first * self.single.shape[1] + second
            hit = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            p += np.where(self.pairs[hit] == key, self.extra[:, hit], 0.0)
        ratio = np.log(p[TOXIC]) - np.log(p[ORDINARY])
        ratio[ratio < self.least] = 0.0
        upto = np.concatenate([[0.0], np.cumsum(ratio)])
        ends = np.cumsum(size)
        total = upto[ends] - upto[ends - size]
        n = np.maximum(size, 1)
        return np.stack([total / n, total / np.sqrt(n)], 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.curve[0] + self.ratios(texts) @ self.curve[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def discount(counts: np.ndarray) -> float:
    """Kneser-Ney's estimate n1 / (n1 + 2 n2)."""
    ones, twos = (counts == 1).sum(), (counts == 2).sum()
    return ones / (ones + 2 * twos) if ones and twos else 0.75


def _level(counts: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, float]:
    """Discounted shares of one order's ``listed`` columns and its backoff mass.

    The mass is the mean of both classes: what has no count here then gets the same in both.
    """
    n = counts[:, listed].astype(float)
    n = np.where(n > 1, n - np.array([[discount(c)] for c in counts]), 0.0)
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    own = n.sum(1, keepdims=True)
    free = 1 - float((own / total).mean())
    return (1 - free) * n / np.maximum(own, 1e-12), free


@dataclass
class Grams:
    """Counted word pairs as arrays: a pair is two places in the sorted vocabulary."""

    vocabulary: list[bytes]
    fold: np.ndarray
    label: np.ndarray
    pair: np.ndarray  # first * len(vocabulary) + second
    n: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Grams:
        """From the columns ``fold, toxic, v, w, n``; a word is held once, whatever pairs it is in."""
        both = pa.chunked_array([*table["v"].chunks, *table["w"].chunks], pa.binary())
        vocabulary = both.unique().sort()
        first, second = (pc.index_in(table[c], vocabulary).to_numpy() for c in ("v", "w"))
        fold, label, n = (table[c].to_numpy() for c in ("fold", "toxic", "n"))
        return cls(vocabulary.to_pylist(), fold, label, first * np.int64(len(vocabulary)) + second, n)

    def of_class(self, label: int, left_out: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First, second and count of a class's pairs in all folds but one."""
        use = self.label == label
        if left_out is not None:
            use &= self.fold != left_out
        pair, at = np.unique(self.pair[use], return_inverse=True)
        first, second = np.divmod(pair, max(len(self.vocabulary), 1))
        return first, second, np.bincount(at, self.n[use], len(pair)).astype(np.int64)


def estimate(grams: Grams, left_out: int | None = None) -> Model:
    """From counts of word pairs per class.

    Orders are pair in class, word in class, word's beginning in class, beginning at
    large.  A lower order counts contexts, not occurrences: a word in its class by the
    words before it, a beginning at large by the classes it occurs in.  Pairs and words seen once keep only their share of the
    backoff mass, which is what a discount of their whole count gives.
    """
    vocabulary, types = grams.vocabulary, len(grams.vocabulary)
    pairs = [grams.of_class(c, left_out) for c in (ORDINARY, TOXIC)]
    once = np.array([np.bincount(second, minlength=types) for _, second, _ in pairs])
    beginnings = sorted({w[:HEAD] for w in vocabulary})
    place = {h: i for i, h in enumerate(beginnings)}
    head = np.fromiter((place[w[:HEAD]] for w in vocabulary), np.int64, types)
    heads = np.array([np.bincount(head, n, len(beginnings)).astype(np.int64) for n in once])
    known, stems = (np.flatnonzero(n.sum(0) > 1) for n in (once, heads))
    number = {vocabulary[w]: i for i, w in enumerate(known.tolist(), 1)}
    number |= {STEM + beginnings[h]: i for i, h in enumerate(stems.tolist(), len(known) + 1)}
    number[START] = len(number) + 1
    size = len(number) + 1
    # The shared order: one count for each class a beginning occurs in, one for all unknown ones.
    shared = (heads > 0).sum(0)
    at_large = int(shared.sum()) + 1
    stem, free = _level(heads, stems)
    stem += free * shared[stems] / at_large
    word, free = _level(once, known)
    word += free * stem[:, np.searchsorted(stems, head[known])]
    single, back = np.full((2, size), 1.0 / at_large), np.ones((2, size))
    single[:, 1:len(known) + 1] = word
    single[:, len(known) + 1:len(known) + 1 + len(stems)] = free * stem

    numbers = np.zeros(types, np.int64)
    numbers[known] = np.arange(1, len(known) + 1)
    if vocabulary and vocabulary[0] == START:  # no word sorts before it
        numbers[0] = number[START]
    kept, mass = [], []
    for first, second, n in pairs:
        after = np.bincount(first, n, types)
        use = np.flatnonzero((n > 1) & (numbers[first] > 0) & (numbers[second] > 0))
        share = (n[use] - discount(n)) / after[first[use]]
        key = numbers[first[use]] * size + numbers[second[use]]
        kept.append((key, share))
        mass.append(np.bincount(key // size, share, size))
    # Contexts that only one class knows say nothing: there both use single words.
    weight = np.where((mass[ORDINARY] > 0) & (mass[TOXIC] > 0), (mass[ORDINARY] + mass[TOXIC]) / 2, 0.0)
    back -= weight
    keys = np.union1d(kept[ORDINARY][0], kept[TOXIC][0])
    keys = keys[weight[keys // size] > 0]
    extra = np.zeros((2, len(keys)))
    for c, (key, share) in enumerate(kept):
        use = weight[key // size] > 0
        at = key[use] // size
        extra[c, np.searchsorted(keys, key[use])] = share[use] / mass[c][at] * weight[at]
    return Model(number, single, back, keys, extra, np.zeros(3))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic curve by Newton steps on standardised columns."""
    spread = x.std(0) + 1e-12
    a = np.column_stack([np.ones(len(x)), x / spread])
    beta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(beta))
        beta += np.linalg.solve(h, a.T @ (weight * (y - p)) - ridge * beta)
    return np.concatenate([[beta[0]], beta[1:] / spread])


FOLDS = 3


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1400, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", cost: float = 1.5) -> Model | None:
    """Fit on about ``per_class`` labelled documents of each class (the documented bound).

    They are drawn from the labels by the hash of the id, so the sample is known before
    a text is read: at most about twice ``per_class`` ids are broadcast and no text but
    the sample's moves.  Labels other than 0 and 1 and null ids and texts teach nothing;
    of several labels the toxic one counts.  The whole sample is counted.  The curve is
    fitted on the ratios each third gets from the other two, so on texts their counts have
    not seen; the classes weigh their true shares, a missed toxic text ``cost`` times a
    false alarm.  None if a class has fewer than two labels: then nothing is known and
    ``score`` says so.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")) \
        .filter("_id IS NOT NULL AND toxic IN (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(totals.get(TOXIC, 0), totals.get(ORDINARY, 0)) < 2:
        return None
    share = {c: min(1.0, per_class / totals[c]) for c in totals}
    unit = F.pmod(F.xxhash64(F.lit(3), "_id"), F.lit(1 << 20)) / float(1 << 20)
    limit = F.when(F.col("toxic") == TOXIC, share[TOXIC]).otherwise(share[ORDINARY])
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(marks.filter(unit < limit)), F.col("_doc") == F.col("_id"))
    once = write_through(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")
    drawn = once.withColumn("fold", F.pmod(F.xxhash64(F.lit(4), "text"), F.lit(FOLDS)).cast("int"))
    if once.isEmpty():
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text, label, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = words(text)
                held.update({(fold, label, v, w) for v, w in zip((START, *own), own)})
        f, c, v, w = zip(*held) if held else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(c, pa.int32()), pa.array(v, pa.binary()),
                                          pa.array(w, pa.binary()), pa.array(held.values(), pa.int64())], names=["fold", "toxic", "v", "w", "n"])

    counted = drawn.select("text", "toxic", "fold").mapInArrow(count, "fold int, toxic int, v binary, w binary, n long")
    grams = Grams.of(counted.groupBy("fold", "toxic", "v", "w").agg(F.sum("n").alias("n")).toArrow())

    def ratios(fold: int) -> pd.DataFrame:
        """The ratios of one fold's texts by the other folds' model; one model is held at a time."""
        shared = docs.sparkSession.sparkContext.broadcast(estimate(grams, fold))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = shared.value.ratios(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["toxic", "a", "b"])

        found = drawn.filter(F.col("fold") == fold).select("text", "toxic").mapInArrow(measure, "toxic int, a double, b double").toPandas()
        shared.unpersist()
        return found

    seen = pd.concat([ratios(fold) for fold in range(FOLDS)])
    model = estimate(grams)
    if seen["toxic"].nunique() == 2:
        y = seen["toxic"].to_numpy()
        model.curve = calibrate(seen[["a", "b"]].to_numpy(), y, np.where(y == TOXIC, cost / share[TOXIC], 1 / share[ORDINARY]))
    else:  # too few labels for a curve: the sign of the ratio decides
        model.curve = np.array([0.0, 0.0, 1.0])
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, score, predicted``.

    Null and empty texts have a ratio of 0 and get what the curve says there; without
    a model every score is 0.  Null ids and repeated rows keep their row; only id and
    text are read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"]]).add("score", "double")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()))], names=schema.names)

    return rows.mapInArrow(judge, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with all their columns."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(start, 256)
                yield batch.filter(pa.array(shared.value.scores(batch.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(drop, docs.schema)
