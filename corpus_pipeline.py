"""From raw documents to packed training sequences, in five stages.

Every stage gets the documents its predecessor kept and returns a DataFrame; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, mixing, packing, shingles, toxicity
from millrace.llm.common import write_through
from millrace.llm.queries import tokenizer_path
from millrace.tables import load

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the models find toxic go; the labels of all its input teach them."""
    marks = load(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.keep_clean(docs, toxicity.train(docs, marks))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to A-Z case the row with the largest id stays."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word shingle similarity of 0.8 or more stays."""
    return shingles.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix holds it."""
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Models, fingerprints and tokens are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
