"""Copies, null ids and short pieces in numbers: chunks, samples and blocks keep their bounds."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprints, language, packing, queries


@pytest.fixture(scope="module")
def crowded(spark):
    """3,000 rows without id, 3,000 of one id, 3,000 of their own."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 1, F.lit(500)).when(F.col("id") % 3 == 2, F.col("id")).cast("long").alias("doc_id"),
        F.concat(F.lit("text "), "id").alias("text"), F.xxhash64(F.concat(F.lit("text "), "id")).alias("_tie"))


def test_chunks_of_null_and_equal_ids_stay_small(crowded):
    for target in (1000, 50):
        found = fingerprints._chunked(crowded, target).collect()
        assert max(Counter(r["_piece"] for r in found).values()) <= 4 * target
        place = sorted(found, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["_tie"]))
        assert [r["_piece"] for r in place] == sorted(r["_piece"] for r in found)


def test_next_row_across_null_and_equal_ids(crowded):
    found = fingerprints.with_next(crowded.select("doc_id", "text"), "text").collect()
    tie = {r["text"]: r["_tie"] for r in crowded.collect()}
    walk = [r["text"] for r in sorted(
        found, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), -tie[r["text"]]))]
    after = {r["text"]: r["next_text"] for r in found}
    assert [after[t] for t in walk] == walk[1:] + walk[:1]


def test_a_text_of_many_rows_is_taught_once(spark):
    def prose(seed, k):
        rng = np.random.default_rng(seed)
        return " ".join("".join(rng.choice([["ing", "the", "wh"], ["eau", "qué", "ou"]][k], 2)) for _ in range(12))
    once = [(prose(i, i % 2), ["aa", "bb"][i % 2]) for i in range(200)]
    copies = [once[0]] * 700 + [once[1]] * 40
    a = language.train(spark.createDataFrame(once, "text string, lang string"))
    b = language.train(spark.createDataFrame(once + copies, "text string, lang string").repartition(5))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.trust, b.trust)


def check(packed, capacity=2048):
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return len(by)


def test_underfull_sequences_exchange_across_blocks(spark):
    rng = np.random.default_rng(4)
    for low, high, n, block in ((1, 40, 3000, 500), (500, 800, 900, 60), (300, 1500, 1200, 40)):
        sizes = rng.integers(low, high, n).tolist()
        parts = spark.createDataFrame(
            [(i, s, "x", "y") for i, s in enumerate(sizes)], "id long, length long, _fill string, _block string").repartition(4)
        packed = packing.pack(parts, block=block)
        found = packed.collect()
        assert packed.columns == ["id", "length", "_fill", "_block", "sequence_id", "offset"]
        assert Counter((r["id"], r["length"], r["_fill"], r["_block"]) for r in found) == Counter((i, s, "x", "y") for i, s in enumerate(sizes))
        # No worse than blocks of the same size that never exchange.
        alone = sum(len(set(packing.pack_block(sizes[i:i + block], 2048)[0])) for i in range(0, n, block))
        assert -(-sum(sizes) // 2048) <= check(found) <= alone


def test_two_for_one_in_sequences_of_many_pieces():
    # The room of 40 takes no piece of the other bin for nothing or for one of 20, but 70 for two.
    sizes = [20] * 70 + [70, 100]
    bins = packing.Bins(sizes, 1440)
    bins.adopt([0] * 70 + [1, 1])
    for b in range(2):
        bins.index(b)
    bins.traded = set()
    assert bins.improve(0) and bins.fill == [1430, 140]


def test_queries_on_documents_keep_names_and_types(spark, sf):
    want = {
        "op1_pareto_mix": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
        "op4_blob_ledger": {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
        "op6_one_permutation_minhash": {"n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                                        "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
        "op8_ecoc_language": {"held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op9_swap_packing": {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                             "sequence_id": "bigint", "offset": "bigint"},
        "op10_kneser_ney_toxicity": {"held_out": "boolean", "score": "double", "predicted": "int"},
    }
    registered = queries.QUERIES
    for name, columns in want.items():
        types = dict(registered[name](spark, sf).dtypes)
        assert {c: types[c] for c in columns} == columns, name
