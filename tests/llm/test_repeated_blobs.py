"""Secrets in rows that repeat."""

import hashlib
import re
from collections import Counter

from millrace.llm import queries, secrets


def test_repeated_rows_and_null_ids_with_secrets(spark, tmp_path):
    """Copies of one id and text, and of a text whose ids are all null, are one blob each."""
    access, hexed = re.compile("AKIA[A-Z0-9]{14,}"), re.compile("[0-9a-f]{16,}")
    twice = "x AKIA" + "Z" * 16 + " then 0123456789abcdef01 and AKIA" + "Q" * 18
    alone = "-- 00112233445566778899 AKIA" + "B" * 20
    once = "AKIA" + "C" * 15
    rows = [(1, twice)] * 3 + [(2, twice), (None, twice)] + [(None, alone)] * 4 + [(3, once)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter()
    for i, t in rows:
        spans = sorted((m.start(), k, m.end()) for k, p in ((1, access), (2, hexed)) for m in p.finditer(t))
        want[i, hashlib.sha256(t.encode()).hexdigest(), tuple(spans)] += 1
    found = secrets.find(docs, str(tmp_path / "ledger"))
    assert Counter((r[0], r[1], tuple(tuple(s) for s in r[2])) for r in found.collect()) == want
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    counts = {(r["n_access"], r["n_hex"]) for r in queries.blob_ledger(spark, str(tmp_path)).filter("doc_id <= 2").collect()}
    assert counts == {(2, 1)}
