"""Personal data by anchor expansion.

One Aho-Corasick automaton walks a text once and finds its anchors: at-signs, digits,
plus signs before a digit, web schemes and the cues that announce an account or a
telephone number.  From an anchor a small parser expands to the left and right by fixed
rules, checks what it has and says where it begins and ends.  Nothing else of the text
is looked at, so the work is one pass and the neighbourhoods of the anchors.

Base kinds are what a plain left-to-right search of one pattern per kind gives:
``email``, ``ip`` (four numbers up to 255), ``card`` (13 to 19 digits that pass Luhn's
test) and ``phone`` (a plus sign and 9 to 15 digits).  A failing candidate is dropped
and the search goes on behind it.  Cues add ``url`` (a web address that names a person:
with user data or a profile path), ``tel`` (digits after a telephone cue), ``iban``
(passing its check digits) and ``account`` (an identifier after an account cue).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

KINDS = ("email", "ip", "card", "phone", "url", "tel", "iban", "account")
BASE = KINDS[:4]
EMAIL, IP, CARD, PHONE, URL, TEL, IBAN, ACCOUNT = range(len(KINDS))

# Cues in lower case; the automaton also knows them in upper case and with a capital (fixed values).
TEL_CUES = ("tel:", "tel.", "phone", "mobile", "fax", "telefon", "teléfono", "téléphone")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account", "acct", "konto", "cuenta", "compte", "passport", "ssn", "customer no", "member id", "user id", "tax id")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
FOUR = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
RUN = re.compile(r"[0-9]++")
SPACED = re.compile(r"[0-9](?:[ -]?[0-9])++")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AFTER_TEL = re.compile(r"(?:[ \t]?(?:number|no\.?|nr\.?|num))?[ \t]?[:.#]?[ \t]?(\(?[0-9][ ()./0-9-]*[0-9])")
AFTER_IBAN = re.compile(r"(?:[ \t]?(?:number|no\.?|nr\.?|is))?[ \t]?[:=#]?[ \t]?([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})(?![A-Za-z0-9])")
AFTER_ACCOUNT = re.compile(r"(?:[ \t]?(?:number|no\.?|nr\.?|num|id|is))?[ \t]?[:=#]?[ \t]?([A-Za-z]{0,4}[0-9](?:[ -]?[0-9]){4,33})(?![A-Za-z0-9])")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?")
USER = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s@/]*)?@")
PROFILE = re.compile(r"/(?:~|@|u/|user/|users/|profile/|people/|in/)[A-Za-z0-9._%-]+")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
        found.add_word("+" + digit, ("plus", 2))
    for scheme in ("http://", "https://", "ftp://"):
        for form in (scheme, scheme.upper(), scheme.capitalize()):
            found.add_word(form, ("scheme", len(form)))
    for kind, cues in (("tel", TEL_CUES), ("iban", IBAN_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled; the digit sum ends in zero."""
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def check_digits(account: str) -> bool:
    """The ISO 13616 test: first four characters last, letters as 10 to 35, remainder 1 by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def only_digits(part: str) -> str:
    return "".join(c for c in part if "0" <= c <= "9")


class Finder:
    """Spans of one text at a time; made once per task."""

    def __init__(self):
        self.anchors = _automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """``(kind, start, end)`` in code points, by kind, then start."""
        spans: list[tuple[int, int, int]] = []
        # Where the search of each kind goes on: behind its last match or failed candidate.
        after = dict.fromkeys(range(len(KINDS)), 0)
        for last, (anchor, size) in self.anchors.iter(text):
            start = last + 1 - size
            if anchor == "digit":
                if start >= after[IP]:
                    self._ip(text, start, after, spans)
                if start >= after[CARD]:
                    self._card(text, start, after, spans)
            elif anchor == "at":
                self._email(text, start, after, spans)
            elif anchor == "plus":
                self._phone(text, start, after, spans)
            elif anchor == "scheme":
                self._url(text, start, last + 1, after, spans)
            else:
                self._announced(anchor, text, start, last + 1, after, spans)
        spans.sort()
        return spans

    @staticmethod
    def _email(text, at, after, spans):
        start, least = at, after[EMAIL]
        while start > least and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((EMAIL, start, domain.end()))
            after[EMAIL] = domain.end()

    @staticmethod
    def _ip(text, at, after, spans):
        four = FOUR.match(text, at)
        if not four:
            after[IP] = RUN.match(text, at).end()
            return
        after[IP] = four.end()
        parts = [p.lstrip("0") for p in four.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            spans.append((IP, at, four.end()))

    @staticmethod
    def _card(text, at, after, spans):
        run = SPACED.match(text, at)
        after[CARD] = run.end() if run else at + 1
        if run and run.end() - at <= 37:  # 19 digits and 18 separators at most
            digits = only_digits(run.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((CARD, at, run.end()))

    @staticmethod
    def _phone(text, at, after, spans):
        if at < after[PHONE]:
            return
        run = DIALLED.match(text, at)
        if run:
            after[PHONE] = run.end()
            if 9 <= len(only_digits(run.group())) <= 15:
                spans.append((PHONE, at, run.end()))

    @staticmethod
    def _url(text, start, at, after, spans):
        if start < after[URL]:
            return
        user = USER.match(text, at)
        host = HOST.match(text, user.end() if user else at)
        if not host:
            return
        path = PROFILE.match(text, host.end())
        if user or path:
            end = path.end() if path else host.end()
            end = max(len(text[:end].rstrip(".,;:!?")), host.end()) if path else end
            spans.append((URL, start, end))
            after[URL] = end

    @staticmethod
    def _announced(anchor, text, cue, at, after, spans):
        if cue and (text[cue - 1].isalnum() or text[cue - 1] == "_"):
            return  # inside another word
        if anchor == "tel":
            found = AFTER_TEL.match(text, at)
            if found and found.start(1) >= after[TEL] and 7 <= len(only_digits(found.group(1))) <= 15:
                spans.append((TEL, found.start(1), found.end(1)))
                after[TEL] = found.end(1)
            return
        if anchor == "iban":
            found = AFTER_IBAN.match(text, at)
            plain = found.group(1).replace(" ", "") if found else ""
            if found and found.start(1) >= after[IBAN] and plain.isascii() and len(plain) <= 34 and check_digits(plain):
                spans.append((IBAN, found.start(1), found.end(1)))
                after[IBAN] = found.end(1)
            return
        found = AFTER_ACCOUNT.match(text, at)
        if found and found.start(1) >= after[ACCOUNT]:
            spans.append((ACCOUNT, found.start(1), found.end(1)))
            after[ACCOUNT] = found.end(1)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, spans``, an array of ``kind`` (place in ``KINDS``), ``start``
    and ``end`` in code points, by kind, then start.

    A row's text never leaves its task and no row meets another, so copies, hot sources
    and very long texts change nothing but the work of their own rows.  Null and empty
    texts have no spans; null ids and repeated rows keep their row; only id and text are
    read, so further columns may have any name; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = StructType([StructField("kind", IntegerType()), StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([rows.schema["doc_id"], StructField("spans", ArrayType(span))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(at, 256)
                found = [finder(t.as_py() or "") for t in batch.column(1)]
                flat = [s for spans in found for s in spans]
                ends = [0]
                for spans in found:
                    ends.append(ends[-1] + len(spans))
                kind, start, end = zip(*flat) if flat else ((), (), ())
                values = pa.StructArray.from_arrays(
                    [pa.array(kind, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["kind", "start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=schema.names)

    return rows.mapInArrow(work, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[str, ...] = BASE) -> DataFrame:
    """``docs`` with every span of ``kinds`` replaced by its kind in angle brackets.

    Overlapping spans are replaced together by the kind that begins first (of equal
    beginnings the one listed first).  Null texts stay null; all other columns stay.
    """
    marks = [KINDS.index(k) for k in kinds]
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text, out, upto = value.as_py(), [], 0
                for start, kind, end in sorted((s, k, e) for k, s, e in finder(text or "") if k in marks):
                    if start >= upto:
                        out += [text[upto:start], f"<{KINDS[kind]}>"]
                    upto = max(upto, end)
                texts.append(None if text is None else "".join(out) + text[upto:])
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(work, docs.schema)
