"""Near copies against brute force over shingle sets."""

import numpy as np

import corpus_pipeline
from millrace.llm import shingles


def sets(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def like(a, b):
    return len(a & b) / len(a | b)


def test_near_dedup_decides_by_shingle_similarity(spark):
    """Pairs on both sides of 0.8, a group around one text, and a repeated line that outweighs the rest."""
    rng = np.random.default_rng(8)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 50_000, n)]
    texts = []
    for nr in range(160):
        base = words(200)
        edits = 1 + nr % 8
        other = list(base)
        for at in rng.choice(40, edits, replace=False) * 5:
            other[at] = "edited"
        texts += [" ".join(base), " ".join(other)]
    base = words(60)
    for at in range(0, 60, 2):
        texts.append(" ".join([*base[:at], "changed", *base[at + 1:]]))
    texts.append(" ".join(base))
    line, rest = words(12), words(300)
    texts += [" ".join(line * 60 + rest), " ".join(rest + line)]
    own = [sets(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if like(own[i], own[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {find(i) for i in range(len(texts))}
    assert 40 < len(texts) - len(want) < len(texts) - 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    assert {r["doc_id"] for r in stage(spark, docs, "").collect()} == want


def pairs_at(similarity, count, size, seed):
    """Pairs of random shingle sets whose similarity is just above ``similarity``."""
    rng = np.random.default_rng(seed)
    for _ in range(count):
        both = int(np.ceil(2 * size * similarity / (1 + similarity)))
        pool = rng.integers(0, 1 << 63, 2 * size - both, np.uint64)
        yield np.unique(pool[:size]), np.unique(pool[size - both:])


def test_recall_at_the_threshold():
    width = 64 * shingles.WORDS // shingles.SEGMENTS
    for size, least in ((400, 0.97), (60, 0.96), (9, 0.9)):
        hit = 0
        for a, b in pairs_at(0.8, 400, size, size):
            differ = np.unpackbits((shingles.fingerprints(a) ^ shingles.fingerprints(b)).view(np.uint8))
            rounds = differ.reshape(shingles.ROUNDS, -1)
            hit += any(r.sum() <= shingles.FAR and (r.reshape(-1, width).sum(1) <= 1).any() for r in rounds)
        assert hit / 400 >= least, (size, hit / 400)


def test_large_keys_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 9999, 80)]
    rows = [(i, " ".join([*base[:i % 80], f"x{i}", *base[i % 80 + 1:]])) for i in range(120)]
    rows += [(1000 + i, " ".join(f"v{j}" for j in rng.integers(0, 9999, 30))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def ids():
        return sorted(r["doc_id"] for r in shingles.keep_one(docs).collect())
    whole = ids()
    assert whole == [0, *range(1000, 1030)]
    monkeypatch.setattr(shingles, "BLOCK", 16)
    assert ids() == whole


def test_odd_rows_of_the_near_dedup_stage(spark):
    text = " ".join(f"word{i}" for i in range(100))
    near = text + " tail"
    schema = "doc_id long, text string, row string, node int, _gone string, component_id int"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, text), (5, near), (4, text), (None, near), (None, None), (6, "one"), (7, "One"),
            (8, "x" * 200_000), (9, "long " * 50_000), (10, "a b c d e f"), (11, "a b c d")]
    docs = spark.createDataFrame([(*r, "x", 1, None, 2) for r in rows], schema).repartition(3)
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    kept = stage(spark, docs, "")
    assert kept.schema == docs.schema
    # Texts without words are one group, equal rows stay together, a null id comes last.
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 4, 6, 8, 9, 10, 11]
    assert stage(spark, docs.limit(0), "").collect() == []
    lone = spark.createDataFrame([(None, "just one")], "doc_id long, text string")
    assert stage(spark, lone, "").count() == 1


def test_links_beside_nearer_rows_that_are_not_alike(spark):
    """Two texts just above 0.8, each amid many that are a little below and mostly nearer by fingerprint."""
    rng = np.random.default_rng(5)
    n = 300

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 500_000, n)]

    def edited(base, cut, at):
        return [*base[:at], *words(cut), *base[at + cut:]]
    texts, kept = [], set()
    for _ in range(6):
        x = words(n)
        y = edited(x, 28, 130)  # 32 of 296 shingles change, 35 of them below
        group = [edited(b, 31, int(at)) for b in (x, y) for at in [*rng.integers(4, 90, 60), *rng.integers(170, 260, 60)]]
        group = [" ".join(t) for t in [*group, x, y]]
        own = [sets(t) for t in group]
        assert like(own[-1], own[-2]) >= 0.8
        root = list(range(len(group)))
        for i in range(len(group)):
            for j in range(i):
                if root[i] != root[j] and like(own[i], own[j]) >= 0.8:
                    root = [root[j] if r == root[i] else r for r in root]
        kept |= {len(texts) + root.index(r) for r in set(root)}
        texts += group
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in shingles.keep_one(docs).collect()} == kept
