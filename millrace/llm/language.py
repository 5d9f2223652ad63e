"""Language identification with error-correcting output codes.

Every language has a codeword; each bit is a linear classifier over hashed byte
n-grams of the whole text.  Decoding takes the codeword of least weighted loss, and
a small gap to the runner-up flags the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

UNDETERMINED = "und"
DIMS = 1 << 12
# Multipliers of the n-gram hash, one per length.
MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def features(text: str) -> np.ndarray:
    """Square roots of the frequencies of byte 1-, 2- and 3-grams, hashed, unit length."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint64)
    counts = np.zeros(DIMS)
    gram = raw
    for n, mix in enumerate(MIX):
        if n:
            gram = (gram[:-1] << np.uint64(8)) | raw[n:]
        slot = ((gram + np.uint64(n + 1)) * mix) >> np.uint64(64 - DIMS.bit_length() + 1)
        counts += np.bincount(slot.astype(np.int64), minlength=DIMS)
    counts = np.sqrt(counts)
    return (counts / (np.linalg.norm(counts) or 1.0)).astype(np.float32)


def codebook(classes: int, seed: int = 7) -> np.ndarray:
    """+1/-1 codewords, one row per class: all splits for few classes, else spread random ones."""
    if classes <= 7:
        bits = max(1, 2 ** (classes - 1) - 1)
        # Column b holds the binary digits of b + 2 ** (classes - 1): class 0 is always +1.
        return np.array([[1 if ((b + 2 ** (classes - 1)) >> (classes - 1 - k)) & 1 else -1
                          for b in range(bits)] for k in range(classes)])
    bits, rng, best, far = int(np.ceil(10 * np.log2(classes))), np.random.default_rng(seed), None, -1
    for _ in range(50):
        book = rng.choice([-1, 1], (classes, bits))
        apart = np.abs(book @ book.T - bits * np.eye(classes)).max()
        if best is None or bits - apart > far:
            best, far = book, bits - apart
    return best


@dataclass
class Model:
    langs: list[str]
    book: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # dims x bits
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trust: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # class x bit

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, score and gap to the runner-up of each row."""
        if len(self.langs) == 1:
            one = np.ones(len(x))
            return np.zeros(len(x), int), one, one
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.book[None]) * self.trust[None]
        like = np.exp(-(loss.sum(2) - loss.sum(2).min(1, keepdims=True)))
        like /= like.sum(1, keepdims=True)
        top = np.sort(like, 1)
        return like.argmax(1), top[:, -1], top[:, -1] - top[:, -2]


def fit(x: np.ndarray, y: np.ndarray, langs: list[str], steps: int = 120, decay: float = 1e-5) -> Model:
    """One logistic classifier per bit, classes weighted alike (accelerated gradient)."""
    if len(langs) < 2:
        return Model(langs)
    book = codebook(len(langs))
    target = book[y]
    each = np.bincount(y, minlength=len(langs))
    row = (1.0 / (len(langs) * np.maximum(each, 1)))[y][:, None]
    w, b = np.zeros((x.shape[1], book.shape[1]), np.float32), np.zeros(book.shape[1])
    mean, rate = x.mean(0), 4.0
    x = x - mean
    last_w, last_b = w, b
    for step in range(steps):
        push = step / (step + 3)
        look_w, look_b = w + push * (w - last_w), b + push * (b - last_b)
        slope = -target / (1 + np.exp(np.clip(target * (x @ look_w + look_b), -30, 30))) * row
        last_w, last_b = w, b
        w = (look_w - rate * (x.T @ slope.astype(np.float32) + decay * look_w)).astype(np.float32)
        b = look_b - rate * slope.sum(0)
    right = (np.sign(x @ w + b) == target).astype(float)
    trust = np.stack([right[y == k].mean(0) if each[k] else np.ones(book.shape[1]) for k in range(len(langs))])
    trust *= book.shape[1] / np.maximum(trust.sum(1, keepdims=True), 1e-9)  # weights of a class sum to the bits
    return Model(langs, book, w, b - mean @ w, trust)


def train(docs: DataFrame, sample: int = 6000, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on about ``sample`` texts (the documented bound), spread over the languages.

    Rows without text, letters or language teach nothing; no rows give a model without
    languages.  A text is drawn by its hash, so reruns fit the same model, and taught once per
    language however many rows hold it: distinct texts are counted, copies merged once drawn.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .filter("text IS NOT NULL AND lang IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    langs = sorted(counts)
    if len(langs) < 2:
        return Model(langs)
    shares = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, sample / len(langs) / max(1, counts[k])))])
    drawn = rows.filter((F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(1 << 20)) / float(1 << 20))
                        < F.element_at(shares, F.col("lang"))).dropDuplicates(["lang", "text"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).astype(np.float16).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.binary())], names=["lang", "x"])

    found = drawn.mapInArrow(extract, "lang string, x binary").toPandas().sort_values(["lang", "x"], ignore_index=True)
    x = np.stack([np.frombuffer(v, np.float16) for v in found["x"]]).astype(np.float32)
    return fit(x, found["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(), langs)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            gap: float = 0.2) -> DataFrame:
    """One row per row: ``doc_id, lang_pred, score, ambiguous``.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learnt.
    ``ambiguous`` marks a lead over the second language below ``gap``.  Null ids and
    repeated rows keep their row; only id and text are read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("lang_pred", StringType())]).add("score", "double").add("ambiguous", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dims x bits, set by the number of languages

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(start, 256)
                texts = batch.column(1).to_pylist()
                able = [i for i, t in enumerate(texts) if t and model.langs and any(map(str.isalpha, t))]
                lang, score, unsure = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                if able:
                    best, sure, lead = model.predict(np.stack([features(texts[i]) for i in able]))
                    for i, k in zip(able, best):
                        lang[i] = model.langs[k]
                    score[able], unsure[able] = sure, lead < gap
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)],
                                                 names=schema.names)

    return rows.mapInArrow(decide, schema)
