"""Anchor expansion against a plain left-to-right search of one pattern per kind."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import personal, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def good(kind, part):
    digits = re.sub("[^0-9]", "", part)
    if kind == "ip":
        return all(int(p) <= 255 for p in part.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def base(text):
    return [(personal.KINDS[k], s, e) for k, s, e in personal.Finder()(text) if k < len(personal.BASE)]


TEXTS = [
    "", "a@b.c", "a@b@c.d", "x.y@a.b@c.d.", "@b.c a@ a@b a@b. é@b.co ÿa@b.co", "a@b.c@d.e f@g.h", "%+@-.-", "1.2.3.4.5.6.7.8.9",
    "256.1.1.1 001.002.003.255 1.2.3 1.2.3.4.", "1..2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "4111111111111111",
    "41111111111111111111", "0000000000000", "+1 (555) 123-4567", "+123456789", "+12", "+1", "++1 23 456 78 90 (", "+1234567890123456",
    "😀 a@b.c 😀 1.2.3.4 +49 30 1234567", "9" * 5000 + "." + "8" * 5000, "1 1  1-1--1", "12345678901.2.3.4",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_kinds_equal_a_plain_search(text):
    assert base(text) == brute(text)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.1234+- ()é", max_size=60))
def test_base_kinds_equal_a_plain_search_on_any_text(text):
    assert base(text) == brute(text)


def kinds(text):
    return [(personal.KINDS[k], text[s:e]) for k, s, e in personal.Finder()(text)]


def test_cues_add_spans_and_boundaries_hold():
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00, thanks") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN DE00 3704 0044 0532 0130 00") == []
    assert kinds("account number: 12345-678, please") == [("account", "12345-678")]
    assert kinds("my passport no. C0123456.") == [("account", "C0123456")]
    assert kinds("accountancy 12345678 and unaccount 123456") == []
    assert kinds("Tel: 030 1234567!") == [("tel", "030 1234567")]
    assert kinds("see https://example.org/~jane. And http://www.example.org/licenses/2.0") == [("url", "https://example.org/~jane")]
    assert kinds("ftp://me:secret@files.example.org/x") == [("email", "secret@files.example.org"), ("url", "ftp://me:secret@files.example.org")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, "x") for i, t in enumerate(TEXTS)] + [(None, None, "a", "b"), (7, None, "", None), (1, "a@b.c", None, "x")]
    rows.append((90, "lorem " * 40_000 + "z@y.org", None, None))
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string").repartition(3), rows


def test_table_with_odd_rows(odd, spark):
    docs, rows = odd
    got = Counter((r["doc_id"], tuple((personal.KINDS[s["kind"]], s["start"], s["end"]) for s in r["spans"]
                                      if s["kind"] < len(personal.BASE))) for r in personal.find(docs).collect())
    assert got == Counter((r[0], tuple(brute(r[1]))) for r in rows)
    assert personal.find(docs.limit(0)).collect() == []


def test_redaction_keeps_columns_and_leaves_no_span(odd):
    docs, rows = odd
    out = personal.redact(docs)
    assert out.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] == "<email>" and texts[10] == "<card>" and texts[17] == "+12" and texts[None] is None


def test_registered_query(spark, sf):
    out = queries.QUERIES["op13_anchor_expansion"](spark, sf)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema][:6] == [
        ("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"), ("base_sha256", "string")]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = out.collect()
    assert len(found) == len(texts)
    for r in found:
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        counts = Counter(k for k, _, _ in want)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(counts[k] for k in personal.BASE)
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(r["spans"].split(",")) | {""}
