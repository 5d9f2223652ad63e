"""Reach by rounds and by walks inside the tasks against a plain walk."""

from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from millrace.operators import lineage


def brute(edges, starts, max_depth=None):
    after = {}
    for s, d in edges:
        after.setdefault(s, set()).add(d)
    out = {}
    for label in {l for l, _ in starts}:
        depth = {n: 0 for l, n in starts if l == label}
        queue = deque(depth)
        while queue:
            here = queue.popleft()
            if here is None or (max_depth is not None and depth[here] == max_depth):
                continue
            for n in after.get(here, ()):
                if n not in depth:
                    depth[n] = depth[here] + 1
                    queue.append(n)
        out |= {(label, n, d): 1 for n, d in depth.items()}
    return Counter(out)


EDGES = [(i // 2, i) for i in range(60)] + [(100 + i, 101 + i) for i in range(45)] + [(145, 100), (7, 120), (3, 3), (None, 5), (4, None), (1, 3), (1, 3)]
STARTS = [("a", 1), ("a", 100), ("b", 0), ("c", 130), ("c", 1), ("d", 999), (None, 2), ("e", None), ("a", 1)]


@pytest.mark.parametrize("few", [1000, 0])
@pytest.mark.parametrize("max_depth", [None, 0, 3])
def test_spread_equals_a_plain_walk(spark, few, max_depth, monkeypatch):
    monkeypatch.setattr(lineage, "FOLD", 2)
    monkeypatch.setattr(lineage, "LITTLE", 20)
    edges = spark.createDataFrame(EDGES, "src long, dst long").repartition(3)
    start = spark.createDataFrame(STARTS, "label string, node long").repartition(2)
    got = Counter((r["label"], r["node"], r["depth"]) for r in lineage.spread(edges, start, max_depth, few).collect())
    assert got == brute(EDGES, STARTS, max_depth)


@pytest.mark.parametrize("few", [1000, 0])
def test_empty_sides(spark, few):
    edges, start = spark.createDataFrame([(1, 2)], "src int, dst int"), spark.createDataFrame([("x", 1)], "label string, node int")
    assert lineage.spread(edges, start.limit(0), None, few).collect() == []
    assert [tuple(r) for r in lineage.spread(edges.limit(0), start, None, few).collect()] == [("x", 1, 0)]


def test_a_chain_needs_few_rounds(spark, monkeypatch):
    written = []
    real = lineage.scratch_path
    monkeypatch.setattr(lineage, "scratch_path", lambda *a: written.append(real(*a)) or written[-1])
    edges = spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    start = spark.createDataFrame([("x", 0)], "label string, node long")
    assert lineage.spread(edges, start, None, 0).count() == 61
    rounds = [p for p in written if "spread" in p]
    assert len(rounds) == 1
