"""Document operators against plain Python, on a small table with every odd case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import components, exact, fingerprints, language, mixing, packing, queries, repeats, secrets, simhash
from millrace.llm import suffix_tree, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, row string, _digest int, size int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(["an", "the", "or", "is", "ri", "to"], rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long = prose(1, 20_000)
    near = prose(2, 400)
    texts = [None, None, "", " \t\n ", "one", "One", "ONE two", near, near + " more", near.replace("the", "teh", 1),
             "Ünï ÜNÏ", long, long, prose(3, 90) + "\n" + prose(4, 60), prose(5, 60) + " " + prose(4, 60), "ab" * 400,
             'token = "abcdefghijkl" AKIA' + "Z" * 14 + " 0123456789abcdef0", "secret: short token=secret=abcdefghijklm", "😀 é é"]
    out = [(i, t, "en" if i % 2 else "fr", f"s{i % 4}" if i % 5 else None, None, "x", "y", 1, 2) for i, t in enumerate(texts)]
    out += [out[4], out[7], (None, "no id", None, None, None, None, None, None, None), (None, near, "en", "s1", 0, "", "", 0, 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            kept = i == keep and first
            first &= not kept
            want[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert counted(exact.groups(docs)) == want
    # A digest that stands for many texts must not join them.
    assert counted(exact.groups(docs, digest=lambda t: F.char_length(t) % 3)) == want
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact.groups(empty).count() == 0 and exact.keep_one(empty).count() == 0


def test_mixing(spark, docs, rows, empty):
    mixed = mixing.mix(docs)
    got = mixed.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORDS.findall(r[1] or ""))
    total = sum(size.values())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while len(target) < len(order):
        left = 1.5 * total - sum(2 * size[s] for s in full)
        level = left / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * level > 2 * size[s]}
        full |= over
        if not over:
            target = {s: 2 * size[s] if s in full else weight[s] * level for s in order}
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
    assert counted(mixing.mix(docs)) == Counter(tuple(r) for r in got)
    applied = mixing.apply(docs)
    assert applied.columns == docs.columns
    assert applied.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == sum(r["taken"] for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.apply(empty).count() == 0


def test_mixing_meets_targets(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).cast("int")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    for r in mixing.mix(many).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k")).collect():
        assert abs(r["k"] - r["t"]) <= 2


def test_secrets(docs, rows, empty, spark, tmp_path):
    patterns = [(re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
                (re.compile("AKIA[A-Z0-9]+"), 0, 18), (re.compile("[0-9a-f]+"), 0, 16)]
    want = Counter()
    for r in rows:
        text = r[1] or ""
        spans = sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(patterns) for m in p.finditer(text) if len(m[g]) >= n)
        want[r[0], hashlib.sha256(text.encode()).hexdigest(), tuple(spans)] += 1
    path = str(tmp_path / "ledger")
    found = secrets.find(docs, path)
    base = F.filter("spans", lambda s: s["rule"] < 3)
    got = Counter((r[0], r[1], tuple(tuple(s) for s in r[2])) for r in found.select("doc_id", "blob", base).collect())
    assert got == want and any(k[2] for k in want)
    # A second run scans nothing, a new text one blob per version, a new version every blob once.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    assert secrets.update_ledger(texts, texts, path, secrets.RULES) == 0
    more = texts.unionByName(spark.createDataFrame([(99, "new token=aaaaaaaaaaaaaaaa")], "doc_id long, text string").withColumn("blob", F.sha2("text", 256)))
    assert secrets.update_ledger(more, more, path, secrets.RULES) == 2
    newer = (*secrets.RULES, secrets.Rule("x", "new", 0, 1, 3, False))
    assert secrets.update_ledger(more, more, path, newer) == len({r["blob"] for r in more.collect()})
    assert secrets.find(empty, str(tmp_path / "none")).count() == 0


def simhash_of(text, n):
    words = WORDS.findall(lower(text))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(docs, rows, empty):
    fps = [simhash_of(r[1], 4) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    want = Counter((r[0], f"{fps[i]:016x}", least[find(i)]) for i, r in enumerate(rows))
    found = simhash.near_duplicates(docs, shingle=4, bits=64, distance=4)
    assert counted(found.select("doc_id", F.lower(F.hex("fp")), "component_id")) == want
    kept = simhash.keep_one(exact.keep_one(docs))
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL AND text = 'no id'").count() == 1
    assert {7, 8, 9} & {r["doc_id"] for r in kept.collect()} and kept.count() < exact.keep_one(docs).count()
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_blocks_and_wide_keys(spark, monkeypatch):
    """Keys beyond a block, a chain of near fingerprints, and 128 bits."""
    rng = np.random.default_rng(5)
    center = rng.integers(0, 2, 64)
    fps = []
    for _ in range(60):
        flip = center.copy()
        flip[rng.integers(0, 64, 3)] ^= 1
        fps.append(np.packbits(flip).tobytes())
    fps += [rng.bytes(8) for _ in range(40)]
    ints = sorted({int.from_bytes(f) for f in fps})
    root = {i: i for i in ints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ints:
        for b in ints:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {i.to_bytes(8): find(i).to_bytes(8) for i in ints if sum(find(j) == find(i) for j in ints) > 1}
    table = spark.createDataFrame([(f,) for f in fps], "fp binary")
    distinct = table.distinct()
    for block in (4096, 8):
        keyed = simhash.variants(distinct, 64, 4).repartition(4, "key").sortWithinPartitions("key").collect()
        groups = defaultdict(list)
        for key, fp in keyed:
            groups[key].append(bytes(fp))
        monkeypatch.setattr(simhash, "BLOCK", block)
        put_off = spark.createDataFrame([(k, f) for k, v in groups.items() if len(v) > block for f in v], "key long, a binary")
        small = spark.createDataFrame([(k, f) for k, v in groups.items() if len(v) <= block for f in v], "key long, fp binary")
        links = simhash._linked(small.coalesce(1).sortWithinPartitions("key"), 64, 4).select("a", "b")
        if put_off.count():
            links = links.unionByName(simhash._in_blocks(put_off, 64, 4))
        got = {bytes(r["node"]): bytes(r["root"]) for r in components.components(links).collect()}
        assert got == want
    assert all(any((a ^ b).bit_count() <= 1 for a, b in [(0, 1)]) for _ in simhash.segments(128, 19)) and len(simhash.segments(128, 19)) == 10


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(900, 901), (950, 901), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900, 950: 900}
    assert components.components(edges.filter("a < 0")).count() == 0


def test_suffix_tree(docs, rows, empty):
    learn = docs.filter("doc_id IS NULL OR doc_id < 14")
    c = Counter()
    for r in rows:
        if r[0] is None or r[0] < 14:
            c.update(lower(r[1]).encode().split() + [None])
    n, v = sum(c.values()), len(c)
    fit = suffix_tree.train(learn, symbol_share=1e-3, local_share=1e-4)
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in suffix_tree.score(docs, fit).collect())
    want = Counter()
    for r in rows:
        t = lower(r[1]).encode().split() + [None]
        want[r[0], len(t), sum(c[w] > 0 for w in t), n, round(float(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t)), 6)] += 1
    assert got == want
    assert suffix_tree.score(empty, fit).count() == 0
    assert suffix_tree.score(docs, suffix_tree.train(empty)).count() == len(rows)


def test_suffix_tree_is_a_distribution_and_learns_order(spark):
    """What follows a word here depends on the word before it."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(200):
        t, a = [], "x"
        for _ in range(60):
            a = {"x": "y", "y": "z", "z": "x"}[a] if rng.random() < 0.9 else "xyz"[rng.integers(3)]
            t.append(a)
        texts.append(" ".join(t))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fit = suffix_tree.train(table, symbol_share=1e-3)
    tree = fit.tree
    assert tree.levels[0].kept.any()
    s = {w: int(tree.symbol[tree.known[w]]) for w in (b"x", b"y", b"z")}
    total = 0.0
    for last in [*s.values(), suffix_tree.RARE, suffix_tree.END]:
        out = np.array([suffix_tree.START, s[b"x"], last])
        total += 10 ** tree.log10(out, np.array([0, 1, 2]))[2]
    assert total == pytest.approx(1.0)
    scored = suffix_tree.score(table, fit).agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > 0.7 * scored[1]


def test_fingerprints(docs, rows, empty):
    marked = fingerprints.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text",
                                    derived={"stored": fingerprints.fingerprint(F.col("text"))})
    found = marked.withColumn("near", fingerprints.likeness(F.col("stored"), F.col("next_stored"))).collect()
    ids = [r["doc_id"] for r in found]
    assert Counter(ids) == Counter(r[0] for r in rows)

    def shingles(t):
        w = WORDS.findall(lower(t))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    stored = {}
    for r in found:
        a, b = shingles(r["text"]), shingles(r["next_text"])
        assert r["near"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0, abs=0.16)
        assert stored.setdefault(lower(r["text"]), r["stored"]) == r["stored"]
        assert len(r["stored"]) == (fingerprints.BINS if a else 0)
    # Each row's next text is the text of the row below it, around the end.
    key = [(-(r["doc_id"] if r["doc_id"] is not None else -1), r["text"], r["next_text"]) for r in found]
    below = sorted({k[0] for k in key})
    texts = {k: {t for i, t, _ in key if i == k} for k in below}
    for i, _, following in key:
        assert following in texts[below[(below.index(i) + 1) % len(below)]] | texts[i]
    assert fingerprints.with_next(empty.select("doc_id", "text"), "text").count() == 0


def test_repeats(docs, rows, empty):
    def want(length):
        texts = [(r[1] or "").encode() for r in rows]
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        out = Counter()
        for r, t in zip(rows, texts):
            gone = np.zeros(len(t), bool)
            for i in range(len(t) - length + 1):
                if seen[t[i:i + length]] > 1:
                    gone[i:i + length] = True
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
            out[r[0], len(t), tuple(zip(edge[::2].tolist(), edge[1::2].tolist())), hashlib.sha256(kept).hexdigest()] += 1
        return out

    def got(**options):
        return Counter((r[0], r[1], tuple(tuple(s) for s in r[2]), r[3]) for r in repeats.find(docs, **options).collect())
    assert got() == want(200)
    assert got(largest=0) == want(200)  # every key through the windows' own path
    assert got(length=60, gram=16, bytes_each=4000) == want(60)
    assert repeats.find(empty).count() == 0


def test_transform_of_random_collections():
    rng = np.random.default_rng(9)
    for trial in range(40):
        texts = [bytes(rng.choice(list(b"ab" if trial % 2 else b"abcd"), rng.integers(0, 40))) for _ in range(rng.integers(1, 9))]
        counts = rng.integers(1, 3, len(texts))
        for length in (4, 9, 16):
            seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
            flags = repeats.repeated(texts, counts, length)
            for t, f, c in zip(texts, flags, counts):
                assert f.tolist() == [seen[t[i:i + length]] > 1 or c > 1 for i in range(len(t) - length + 1)]


def test_packing(docs, rows, empty):
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path)
    packed = packing.pack(packing.pieces(docs, path, with_ids=True)).collect()
    want = Counter()
    for r in rows:
        ids = np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for nr, (a, n) in enumerate(packing.cuts(len(ids), 2048)):
            assert 0 < n <= 2048 and (nr == 0 or n == 2048)
            want[r[0], nr, a, n, zlib.crc32(ids[a:a + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 2048
    assert len(by) == -(-sum(r["length"] for r in packed) // 2048)
    assert packing.pack(packing.pieces(empty, path)).count() == 0


def test_encoder_takes_any_white_space():
    encode = packing.Encoder(queries.tokenizer_path())
    for text in ("a  b\n c", "\n", "don't we'll \t x", "<|endoftext|> a", "Ünï 😀 é 12 34a", "", " lead", "trail ", "x\n\n y", "a\0 b", "a  b", " ", "a  b"):
        assert encode(text) == encode.plain(text) == encode(text)


def test_local_search_beats_best_fit():
    rng = np.random.default_rng(2)
    sizes = rng.integers(500, 800, 600).tolist()
    start = packing.Bins(sizes, 2048)
    start.best_fit()
    at, offset, _ = packing.pack_block(sizes, 2048)
    fill = Counter()
    for b, n in zip(at, sizes):
        fill[b] += n
    assert max(fill.values()) <= 2048 and len(fill) < len(start.items)


def test_language(spark, empty):
    def of(seed, syllables, n):
        rng = np.random.default_rng(seed)
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))
    kinds = {"aa": ["ing", "the", "th", "wh"], "bb": ["eau", "qué", "ou"], "cc": ["sch", "ung", "ö"]}
    table = [(i, of(i, kinds[k], 5 + i % 60), k) for i in range(240) for k in [list(kinds)[i % 3]]]
    train = spark.createDataFrame(table[:180], "doc_id long, text string, lang string")
    test = table[180:] + [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", "aa"), (None, "the thing", None)]
    model = language.train(train)
    got = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()}
    right = [got[i]["lang_pred"] == k for i, _, k in table[180:]]
    assert np.mean(right) > 0.95 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["lang_pred"] == "und" for i in (1000, 1001, 1002)) and got[None]["lang_pred"] in kinds
    assert language.predict(train.select("doc_id", "text"), language.train(empty)).filter("lang_pred <> 'und'").count() == 0
    one = language.predict(train, language.train(train.filter("lang = 'aa'")))
    assert one.filter("lang_pred = 'aa'").count() == 180 and language.predict(empty, model).count() == 0


def test_codewords_are_apart():
    for classes in (2, 3, 4, 7, 8, 30):
        book = language.codebook(classes)
        assert len({tuple(r) for r in book.tolist()}) == classes
        apart = [(book[i] != book[j]).sum() for i in range(classes) for j in range(i)]
        assert min(apart) >= max(1, book.shape[1] // 4)


def test_toxicity(spark, docs, rows, empty):
    rng = np.random.default_rng(4)
    table = []
    for i in range(1200):
        words = prose(i + 100, int(rng.integers(20, 300))).split()
        bad = int(i % 6 == 0)
        for _ in range(4 * bad):
            words.insert(int(rng.integers(len(words))), str(rng.choice(["scoundrel", "wretch", "villain"])))
        table.append((i, " ".join(words), bad))
    table += [(5000, None, 1), (5001, "text", None)]
    all_rows = spark.createDataFrame(table, "doc_id long, text string, toxic int")
    learn = all_rows.filter("doc_id < 900 OR doc_id >= 5000")
    model = toxicity.train(learn, learn.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score(all_rows, model).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert np.mean([got[i]["predicted"] == bad for i, _, bad in table[900:1200]]) > 0.97
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and counted(kept) == counted(docs)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, learn.select("doc_id", "toxic")) is None
    assert toxicity.train(learn, learn.select("doc_id", "toxic").limit(0)) is None
    assert toxicity.score(docs, None).count() == len(rows)


def test_pipeline(spark, sf):
    """Every stage against plain statements of what it may keep."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.toPandas()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        after = out.toPandas()
        if name == "exact dedup":
            want = before.assign(k=before.text.map(lower)).groupby("k").doc_id.max()
            assert sorted(after.doc_id) == sorted(want)
        elif name == "simhash near-dedup":
            def shingles(t):
                w = WORDS.findall(lower(t))
                return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
            gone = before[~before.doc_id.isin(after.doc_id)]
            kept = [shingles(t) for t in before.text]
            for i, t in zip(gone.doc_id, gone.text):  # nothing goes without a like
                a = shingles(t)
                assert max(len(a & b) / len(a | b) for j, b in zip(before.doc_id, kept) if j != i) > 0.5
        elif name == "source mixing":
            assert set(after.doc_id) <= set(before.doc_id) and after.doc_id.value_counts().max() <= 2
        else:
            assert set(after.doc_id) <= set(before.doc_id) and len(after) > 0.8 * len(before)
        docs, before = spark.createDataFrame(after, docs.schema), after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.filter("piece = 0").count() == docs.count()


def test_queries_keep_their_columns(spark, sf):
    for name in ("op3_simhash_variants", "op7_salted_exact_dedup"):
        df = queries.QUERIES[name](spark, sf)
        assert df.count() == 200
