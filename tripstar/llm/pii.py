"""Personal data: patterns propose spans, checks confirm them, context words adjust their score.

Kinds, in the order in which spans of one start are listed: email, ip, card (Luhn), phone, then the
added kinds iban (mod 97), ssn (issued ranges) and local_phone (needs a context word). A span is reported
when its check holds and its score reaches LEAST_SCORE; the first four start above it, so context never
removes them. Spans of an added kind that overlap a span of the first four are left out.

Defined cases: NULL or empty text has no spans; every row is judged by itself; NULL doc_id stays; other
columns are not read. Work is linear in the text, also for long runs of digits or letters.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone")
LEAST_SCORE = 0.7
CONTEXT = 40  # characters before and after a span that are searched for context words
BONUS = 0.25

# Patterns, the score each starts with, and words that raise it when they stand nearby.
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Equal to the plain patterns, which begin at the first digit of a run; the guard saves trying the others.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SCORES = {"email": 0.75, "ip": 0.75, "card": 0.75, "phone": 0.75, "iban": 0.75, "ssn": 0.6, "local_phone": 0.5}
WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
_WORDS = {kind: re.compile(r"(?<!\w)(?:" + "|".join(words) + r")(?!\w)", re.IGNORECASE) for kind, words in WORDS.items()}
_SIGNS = re.compile(r"[0-9@]")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the whole run of allowed characters before each @, and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL_PART))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose check holds."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for m in IP.finditer(text):
        if all(map(_small, m.groups())):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for m in IBAN.finditer(text):
        iban = m[0].replace(" ", "")
        if 15 <= len(iban) <= 34 and mod97(iban):
            yield "iban", *m.span()
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span()
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span()


def find(text: str | None) -> list[Span]:
    """Spans in code points, by start, then kind."""
    if not text or not _SIGNS.search(text):
        return []
    found = []
    for kind, start, end in _proposals(text):
        near = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
        score = SCORES[kind] + (BONUS if _WORDS[kind].search(near) else 0.0)
        if score >= LEAST_SCORE:
            found.append(Span(start, end, kind, score))
    base = [s for s in found if s.kind in BASE]
    base.sort()
    starts, reach = [b.start for b in base], list(accumulate((b.end for b in base), max))
    added = [s for s in found if s.kind not in BASE and not ((k := bisect_left(starts, s.end)) and s.start < reach[k - 1])]
    return sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = "array<struct<start: bigint, end: bigint, kind: string, score: double>>"


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, spans: one row for each row of docs."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[s._asdict() for s in find(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(search, f"doc_id bigint, spans {SPANS}")


def masked(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    if text is None:
        return None
    out, at = [], 0
    for s in find(text):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind}]"]
            at = s.end
    return "".join([*out, text[at:]])
