"""The suffix tree in tables against one of dictionaries."""

from collections import Counter, defaultdict
from math import log, log10, sqrt

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import suffix_tree


def plain(learn, depth, least):
    """log10 probability of a text by every context that passes, however rare."""
    split = [["<", *t.split(), ">"] for t in learn]
    single = Counter(w for t in split for w in t[1:])
    room = sum(single.values()) + len(single) + 1
    after = defaultdict(Counter)
    for t in split:
        for i in range(1, len(t)):
            for k in range(1, min(depth, i) + 1):
                after[tuple(t[i - k:i])][t[i]] += 1
    states = {}

    def p(context, w):
        if not context:
            return (single[w] + 1) / room
        q = p(context[1:], w)
        if context not in states:
            return q
        kept, total = states[context]
        return (1 - sum(n - 0.75 for n in kept.values()) / total) * q + (kept[w] - 0.75) / total * (w in kept)

    for context in sorted(after, key=len):
        total = sum(after[context].values())
        kept = Counter({w: n for w, n in after[context].items() if n >= least})
        if kept:
            q = {w: p(context[1:], w) for w in kept}
            apart = sum(n / total * log(n / total / q[w]) for w, n in kept.items())
            left_p, left_q = 1 - sum(kept.values()) / total, 1 - sum(q.values())
            apart += left_p * log(left_p / left_q) if left_p > 1e-12 else 0.0
            if 2 * total * apart > len(kept) + 3 * sqrt(2 * len(kept)):
                states[context] = kept, total

    def of(text):
        t = ["<", *text.split(), ">"]
        return sum(log10(p(tuple(t[max(0, i - depth):i]), t[i])) for i in range(1, len(t)))
    return of, states


def test_rare_contexts_are_states_and_shares_change_nothing(spark):
    rng = np.random.default_rng(7)
    common = [" ".join(rng.choice(["a", "b", "c", "d"], 30, p=[0.6, 0.2, 0.1, 0.1])) for _ in range(150)]
    rare = " ".join(f"r{i}" for i in range(12))
    learn = [*common, rare, rare, f"a {rare} b", "", "once only"]
    texts = [*learn[140:], rare, "r3 r4 r5 unseen r6", "r4 r3", "a a unseen", ""]
    of, states = plain(learn, 3, 2)
    assert ("r3",) in states and ("<", "r0") not in states and any(len(c) > 1 for c in states)
    table = spark.createDataFrame(list(enumerate(learn)), "doc_id long, text string")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for share in (1e-9, 1e-2):
        fit = suffix_tree.train(table, symbol_share=share, local_share=share, least=2)
        got = {r["doc_id"]: r["score"] for r in suffix_tree.score(rows, fit).collect()}
        assert got == pytest.approx({i: of(t) for i, t in enumerate(texts)}, abs=1e-6)


def test_what_is_looked_up_travels_as_arrays(spark, monkeypatch):
    """A row for each text and range, not for each word and sequence; chunks and ranges of any size give the same."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(40)], 200, p=np.arange(1, 41) / 820)) for _ in range(40)]
    learn, texts = texts[:30], [*texts[20:], texts[0], texts[0], "", "unseen w1 w2"]
    of, _ = plain(learn, 3, 2)
    fit = suffix_tree.train(spark.createDataFrame([(t,) for t in learn], "text string"), symbol_share=1.0, local_share=1.0, least=2)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    made, kind = spark.sparkContext.accumulator(0), type(rows)
    original = kind.mapInArrow

    def counted(self, f, *args, **kwargs):
        def g(batches):
            for batch in f(batches):
                made.add(batch.num_rows)
                yield batch
        return original(self, g, *args, **kwargs)

    want = pytest.approx({i: of(t) for i, t in enumerate(texts)}, abs=1e-6)
    with monkeypatch.context() as patched:
        patched.setattr(kind, "mapInArrow", counted)
        assert {r["doc_id"]: r["score"] for r in suffix_tree.score(rows, fit).collect()} == want
    assert made.value <= len(texts) + 2 * 2 ** fit.bits
    monkeypatch.setattr(suffix_tree, "BUCKET", 100)
    found = suffix_tree.score(rows.repartition(2), fit, most=300)
    assert {r["doc_id"]: r["score"] for r in found.collect()} == want
    fine = suffix_tree.train(spark.createDataFrame([(t,) for t in learn], "text string"), symbol_share=1.0, local_share=1.0, least=2)
    assert fine.bits >= 8
    assert {r["doc_id"]: r["score"] for r in suffix_tree.score(rows, fine).collect()} == want


def test_words_are_those_between_the_six_gaps():
    texts = ["", " ", "a", "Ab\tcD\n", "x\x0by\x0cz\r", "\u00a0\u2003w \x1f\x85", "\x00", "\x00\x00 " + "q" * 8, "q" * 9 + " " + "q" * 64,
             "\u00c9T\u00c9 Z" + "y" * 200, "q" * 8, "tail", ""]
    array = pa.array(["cut off", *texts], pa.string()).slice(1)
    size, symbol, place = suffix_tree.symbols(array)
    az = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    split = [t.encode().translate(az).split() for t in texts]
    assert size.tolist() == [len(w) for w in split]
    want = [[suffix_tree.START, *map(suffix_tree.word, w), suffix_tree.END] for w in split]
    assert symbol.tolist() == sum(want, []) and place.tolist() == [i for w in want for i in range(len(w))]
    words = {w for t in split for w in t}
    assert len({suffix_tree.word(w) for w in words}) == len(words)
