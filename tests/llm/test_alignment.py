"""Alignment and pair counts against whole texts encoded and compared byte by byte."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import alignment, queries

A, B = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")


def tokens(text):
    """Both whole token lists with their byte ranges, None if there are none."""
    both = alignment.tokenizers(A, B)
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    plain = (" " + text).encode()
    out = []
    for ids, table in ((a, both.bytes_a), (b, both.bytes_b)):
        if b"".join(table[i] for i in ids) != plain:
            return None
        at, ranges = 0, []
        for i in ids:
            ranges.append((i, at, at + len(table[i])))
            at += len(table[i])
        out.append(ranges)
    return out


def links(a, b):
    return [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]


def groups(a, b):
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    out, start = [], 0
    for cut in cuts:
        out.append(",".join(str(i) for i, s, e in a if start <= s and e <= cut) + "|" + ",".join(str(i) for i, s, e in b if start <= s and e <= cut))
        start = cut
    return out


def brute(rows):
    own = [tokens(t) for _, t in rows]
    linked = [links(*x) if x else [] for x in own]
    count = Counter(p for pairs in linked for p in set(pairs))
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = Counter()
    for (doc, _), x, pairs in zip(rows, own, linked):
        if x is None:
            out[doc, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        cut = groups(*x)
        out[doc, len(x[0]), len(x[1]), len(cut), len(pairs), sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
            hashlib.sha256(";".join(cut).encode()).hexdigest()] += 1
    return out


TEXTS = ["hello world", "hello  world ", " leading", "trailing ", "  ", " ", "", None, "a\n\n b\t c\r\n", "naïve café 東京 😀", "<|endoftext|> <s> <unk> <0x41>",
         "under▁score", " nbsp  wide", "x" * 3000, "ﬁ ligature Å é", "don't we'll 12345 67,890.12", "nul\0byte", "the the the",
         " ".join(f"w{i} it's" for i in range(300)), "​ zero", "\x1c sep \x1d x", "　 ideographic \u0085 next"]


def check(store, text):
    whole = tokens(text)
    own = store.numbers([text])[0]
    assert bool(own) == bool(text)
    facts = store.facts[own]
    assert (not own or bool(facts[:, 4].any())) == (whole is None)
    if whole:
        codes, _ = store.links_of(np.array(own))
        size = len(store.both.bytes_b)
        assert [(int(c) // size, int(c) % size) for c in codes] == links(*whole)
        assert ";".join(store.groups[i] for i in own) == ";".join(groups(*whole))
        assert facts[:, :4].sum(0).tolist() == [len(whole[0]), len(whole[1]), len(groups(*whole)), len(links(*whole))]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet="ab A'1.\n\t 　é東▁<|>\x1c\u0085", max_size=30), max_size=4))
def test_cutting_into_chunks_changes_nothing(texts):
    store = alignment.Known(alignment.tokenizers(A, B), True)
    for text in texts:
        check(store, text)
        store.forget()


def test_forgotten_chunks_are_aligned_again(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN", 5)
    store = alignment.Known(alignment.tokenizers(A, B), True)
    for text in TEXTS + TEXTS:
        check(store, text)
        store.forget()
        assert len(store.number) == len(store.groups) == len(store.facts) == len(store.starts) <= 5


def test_perfect_hash_is_minimal_and_survives_packing():
    for n in (0, 1, 2, 63, 1000, 70_000):
        keys = np.random.default_rng(n).permutation(3 * n)[:n].astype(np.int64)
        built = alignment.PerfectHash.build(keys)
        again = alignment.PerfectHash.unpack(built.pack())
        assert sorted(again.number(keys).tolist()) == list(range(n))
        assert np.array_equal(built.number(keys), again.number(keys))


@pytest.fixture(scope="module")
def rows():
    out = [(i, t) for i, t in enumerate(TEXTS)]
    return out + [out[0], (None, "hello world"), (None, None), (3, "the world " * 500)]


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("most, per_bucket", [(alignment.PAIRS, alignment.PER_BUCKET), (200, 16)])
def test_numbers_equal_brute_force(spark, rows, monkeypatch, most, per_bucket):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, pair int, _row int").repartition(7)
    assert got(alignment.align(docs, A, B, most=most, per_bucket=per_bucket)) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == []
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert got(alignment.align(docs, A, B)) == Counter({(1, 0, 0, 0, 0, 0, 0, ""): 1})


def test_registered_query(spark, sf):
    out = queries.QUERIES["op11_tokenizer_alignment"](spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("doc_id", "bigint"), *[(f, "bigint") for f in alignment.FIELDS], ("groups_sha256", "string")]
    short = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").filter("length(text) < 300 OR text IS NULL")
    rows = [tuple(r) for r in short.collect()]
    assert got(alignment.align(short, A, B)) == brute(rows)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
