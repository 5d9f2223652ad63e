"""The peeled trie against a plain walk over all prefixes."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from millrace.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + turns[c][h:]
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[:d - 1])].add(tuple(path[:d]))
        ends[tuple(path)].append(c)
    leaves, saved = Counter(), Counter()
    for key in sorted(members, key=len, reverse=True):
        words = len(WORDS.findall(key[-1][1])) if key else 0
        saved[key] += (len(members[key]) - 1) * words
        leaves[key] += not children[key]
        if key:
            saved[key[:-1]] += saved[key]
            leaves[key[:-1]] += leaves[key]
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def table(seed, convs=60, longest=9, same=0.4):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        length = rng.randint(1, longest)
        for turn in range(length):
            text = "hello there" if turn == 0 and rng.random() < same else rng.choice(["yes", "no no", "", None, "a\tb c"])
            rows.append((c, turn, rng.choice(["user", "bot", None]) if rng.random() < 0.2 else "user", text, "x", 1))
    return rows


def odd():
    rows = table(1, 45)
    rows += [(45, None, None, None, None, None), (45, None, "user", "b", "", 2), (45, 1, "bot", "é ß", None, None), (45, 1, "bot", "a", None, None)]
    rows += [rows[3], rows[3], (None, 1, "user", "nobody", None, None), (None, None, None, None, None, None)]
    rows += [(-25, 0, "user", "minus", "", 0), (-25, 1, "user", "minus", "", 0), (-20, 0, "user", "hello there", "", 0), (0, 99, "user", "w " * 9000, "", 0)]
    rows += [(c, t, "user", f"copy {t}", "", 0) for c in range(1000, 1060) for t in range(5)]
    rows += [(2000 + c, t, "user", "deep", "", 0) for c in range(3) for t in range(13 + c)]
    return rows


def got(df):
    return Counter(tuple(r) for r in df.drop("node").collect())


@pytest.mark.parametrize("block, most", [(512, 1024), (3, 2), (4, 1000), (512, 2)])
def test_nodes_equal_a_plain_walk(spark, block, most):
    rows = odd()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(trie.nodes(docs, block, most)) == brute(rows)


def test_empty_and_turnless(spark):
    assert trie.nodes(spark.createDataFrame([], SCHEMA)).collect() == []
    # 7 has h turns to lose and no conversation 0 to take them from: it is in the root only.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(lone, 0, "user", "gone", "", 0)]
    assert got(trie.nodes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert brute(rows) == Counter({(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest()): 1})


def test_pieces_of_one_node_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(c, 0, "user", "same", "", 0) for c in range(3000, 3100)] + [(c, 1, "bot", "same", "", 0) for c in range(3000, 3100)]
    assert got(trie.nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_registered_query_equals_its_twin_and_the_plain_walk(spark, sf):
    name = "op12_truncation_peeling"
    out = queries.QUERIES[name](spark, sf)
    assert [f.name for f in out.schema] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    path = f"{sf}/conversations.parquet"
    found = Counter(tuple(r) for r in out.collect())
    assert found == brute([tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    assert found == Counter(con.execute(queries.SQL[name]).fetchall())
