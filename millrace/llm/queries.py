"""Queries of the document operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import alignment, exact, fingerprints, language, mixing, packing, personal, repeats, secrets, simhash, suffix_tree, toxicity, trie
from millrace.llm.common import crc_mod, whole
from millrace.plans.registry import Query
from millrace.tables import load

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_pareto_mix")
def pareto_mix(spark, sf):
    mixed = mixing.mix(load(spark, sf, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _joined(spans, rules):
    kind = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (i, r.kind)]), spans["rule"])
    return F.concat(kind, F.lit(":"), spans["start"].cast("string"), F.lit(":"), spans["end"].cast("string"))


def _of(rule):
    return lambda span: span["rule"] == rule


@query("op4_blob_ledger")
def blob_ledger(spark, sf):
    rules = secrets.RULES
    found = secrets.find(load(spark, sf, "documents", "doc_id", "text"))
    base = [i for i, r in enumerate(rules) if r.base]
    only = F.filter("spans", lambda s: s["rule"].isin(base))
    # A second argument of the function, also one with a default, would be given the span's place.
    counts = [F.size(F.filter("spans", _of(i))).cast("long").alias(f"n_{rules[i].kind}") for i in base]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.array_join(F.transform(only, lambda s: _joined(s, rules)), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", lambda s: _joined(s, rules)), ",").alias("spans"))


@query("op7_salted_exact_dedup", """
    WITH rows AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM rows JOIN g USING (t)
""")
def salted_exact_dedup(spark, sf):
    return exact.groups(load(spark, sf, "documents", "doc_id", "text"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_swap_packing")
def swap_packing(spark, sf):
    parts = packing.pieces(load(spark, sf, "documents", "doc_id", "text"), tokenizer_path())
    return packing.pack(parts).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_simhash_variants")
def simhash_variants(spark, sf):
    found = simhash.near_duplicates(load(spark, sf, "documents", "doc_id", "text"), shingle=4, bits=64, distance=4)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


@query("op8_ecoc_language")
def ecoc_language(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text", "lang").withColumn("held_out", crc_mod("doc_id", 4) == 2)
    model = language.train(docs.filter("NOT held_out"))
    found = language.predict(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op10_kneser_ney_toxicity")
def kneser_ney_toxicity(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    labels = load(spark, sf, "labels", "doc_id", "toxic").filter(crc_mod("doc_id", 5) != 0)
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op6_one_permutation_minhash")
def one_permutation_minhash(spark, sf):
    rows = load(spark, sf, "documents", "doc_id", "text").select("doc_id", whole("text").alias("text"))
    pairs = fingerprints.with_next(rows, "text", derived={"stored": fingerprints.fingerprint(F.col("text"))})
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.left("text", size - third), F.left("next_text", third))
    pairs = pairs.select("doc_id", size.cast("long").alias("n_chars"), "stored", "next_stored", edited.alias("edited"))
    pairs = pairs.select("doc_id", "n_chars", "stored", "next_stored", F.sha2("edited", 256).alias("edited_sha256"),
                         fingerprints.fingerprint(F.col("edited")).alias("changed"))
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.packed(F.col("stored")).alias("fingerprint"),
        fingerprints.packed(F.col("changed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("stored"), F.col("changed")).alias("near_edited"),
        fingerprints.likeness(F.col("stored"), F.col("next_stored")).alias("near_next"))


@query("op5_suffix_tree_scores")
def suffix_tree_scores(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    fit = suffix_tree.train(docs.filter(crc_mod("doc_id", 7) != 2))
    found = suffix_tree.score(docs, fit)
    return found.withColumn("held_out", crc_mod("doc_id", 7) == 2)


@query("op2_column_wise_suffix_dedup")
def column_wise_suffix_dedup(spark, sf):
    found = repeats.find(load(spark, sf, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def _kind(number):
    return lambda span: span["kind"] == number


@query("op13_anchor_expansion")
def anchor_expansion(spark, sf):
    found = personal.find(load(spark, sf, "documents", "doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in personal.KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat(
            F.get(kinds, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("spans", _kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(personal.BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(personal.BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op12_truncation_peeling", r"""
    WITH crc AS (
      SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
    numbered AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT conv_id, n, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
          [4294967295] || list_transform(range(1, length(s) + 1), lambda j: CAST(ascii(substr(s, j, 1)) AS BIGINT)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 4 AS h
      FROM (SELECT conv_id, count(*) AS n, CAST(conv_id AS VARCHAR) AS s FROM numbered GROUP BY conv_id), crc),
    rebuilt AS (
      SELECT c.conv_id, b.place AS depth, b.role, b.text
      FROM convs c JOIN numbered b ON b.conv_id = c.base AND b.place <= c.h
      UNION ALL
      SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + o.place - c.h, o.role, o.text
      FROM convs c JOIN numbered o ON o.conv_id = c.conv_id AND o.place > c.h LEFT JOIN convs b ON b.conv_id = c.base),
    prefixes AS (
      SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        md5(CAST(list(md5(role) || md5(text)) OVER (PARTITION BY conv_id ORDER BY depth) AS VARCHAR)) AS node FROM rebuilt
      UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
    members AS (
      SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
        depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes),
    merged AS (
      SELECT depth, node, min(up) AS up, min(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM members GROUP BY depth, node),
    children AS (SELECT up AS node, count(*) AS n_children FROM merged WHERE up IS NOT NULL GROUP BY up),
    sums AS (
      SELECT a.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved_tokens
      FROM merged m JOIN members a ON a.conv_id = m.conv_id AND a.depth <= m.depth LEFT JOIN children k ON k.node = m.node
      GROUP BY a.node)
    SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, m.n_convs,
      coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
    FROM merged m LEFT JOIN merged p ON p.node = m.up LEFT JOIN children k ON k.node = m.node JOIN sums s ON s.node = m.node
""")
def truncation_peeling(spark, sf):
    return trie.nodes(load(spark, sf, "conversations", "conv_id", "turn", "role", "text")).drop("node")


@query("op11_tokenizer_alignment")
def tokenizer_alignment(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    return alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
