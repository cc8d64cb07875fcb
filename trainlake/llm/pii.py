"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) stand once confirmed, whatever their
score.  Further kinds (``iban``, ``ssn``) need a score of ``MIN_SCORE`` from checksum and
context.  Positions are code points, ends exclusive.  All searches are linear in the text.
"""

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import map_arrow, texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
MIN_SCORE, NEAR = 0.5, 40


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_ALNUM = re.compile("[A-Za-z0-9]")
#: Characters of an IBAN by country.
_IBAN_SIZES = {
    c: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in codes.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile("[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")

#: Words nearby that speak for a kind.
CONTEXT = {
    "email": {"mail", "email", "contact", "write", "address"},
    "ip": {"ip", "host", "server", "address", "login"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "payment"},
    "phone": {"phone", "call", "tel", "mobile", "fax", "contact"},
    "iban": {"iban", "bank", "account", "transfer", "konto"},
    "ssn": {"ssn", "social", "security"},
}
#: Score of a confirmed span without context, and what context adds.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
ADDED = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _ibans(text: str):
    """Parts that end a word, have their country's length (unknown countries: the longest of 15 to 34) and pass mod-97."""
    m = _IBAN.search(text)
    while m:
        start, end = m.span()
        own = _IBAN_SIZES.get(text[start : start + 2])
        ends, size = [], 0
        for at in range(start, end):
            size += text[at] != " "
            if (size == own if own else size >= 15) and text[at] != " " and not _ALNUM.match(text, at + 1):
                ends.append(at + 1)
        found = next((e for e in reversed(ends) if mod_97(text[start:e])), None)
        if found:
            yield start, found
        m = _IBAN.search(text, found or start + 1)


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        run = text[free:at]
        start = free + len(run.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _proposed(text: str):
    """(kind, start, end) of every match that its validator confirms."""
    for a, b in _emails(text):
        yield "email", a, b
    if _DIGIT.search(text) is None:
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield "phone", m.start(), m.end()
    for a, b in _ibans(text):
        yield "iban", a, b
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()


_DIGIT = re.compile("[0-9]")


def find_spans(text: str) -> list[Span]:
    """Spans by kind as listed, then start."""
    out = []
    for kind, a, b in _proposed(text):
        near = {w.lower() for w in _WORD.findall(text[max(0, a - NEAR) : a] + " " + text[b : b + NEAR])}
        score = min(1.0, START[kind] + ADDED * bool(near & CONTEXT[kind]))
        if kind in BASE or score >= MIN_SCORE:
            out.append(Span(kind, a, b, score))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """Each run of overlapping spans becomes the name, in brackets, of the one that starts first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def pii_spans(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end, score); empty without any."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def step(batch: pa.RecordBatch):
        found = [[s._asdict() for s in find_spans(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    return map_arrow(texts(documents), step, "doc_id LONG, spans ARRAY<STRUCT<kind: STRING, start: LONG, end: LONG, score: DOUBLE>>")


def pii_digests(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text, per document (NULL text: empty)."""
    spans = pii_spans(documents)

    def told(which):
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, BASE), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind; ``n_chars`` counts the text that is left. Other columns stay."""
    names = documents.columns

    def step(batch: pa.RecordBatch):
        given = batch.column("text").to_pylist()
        made = [None if t is None else redacted(t, find_spans(t)) for t in given]
        columns = {n: batch.column(n) for n in names}
        columns["text"] = pa.array(made, batch.schema.field("text").type)
        if "n_chars" in columns:
            sizes = [n if m == t else len(m) for n, m, t in zip(columns["n_chars"].to_pylist(), made, given, strict=True)]
            columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return map_arrow(documents, step, documents.schema)
