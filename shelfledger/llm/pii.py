"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Every span is found on the whole text, in code points, end exclusive. Matches of one kind do not overlap; spans of
different kinds may. Matching is linear in the length of a text, also on runs of a million digits or letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Fixed kinds and patterns of the contract, then the kinds that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, so nothing is tried again inside a run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile("[0-9]")

# Score before context, and what a passed checksum adds.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.4, "ssn": 0.3}
CHECKSUM = {"card": 0.3, "iban": 0.4}
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = ("version", "isbn", "order", "serial", "invoice", "build")
CONTEXT_CHARS = 40
KEPT_SCORE = 0.6

SPAN = "struct<start:bigint,end:bigint,kind:string,score:double>"
_SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())])
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod_97(code: str) -> bool:
    """The check of an IBAN: four characters moved to the end, letters as numbers, remainder 1."""
    rest = 0
    for char in code[4:] + code[:4]:
        value = int(char, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _digits(found: str) -> str:
    return "".join(DIGIT.findall(found))


def _small(part: str) -> bool:
    significant = part.lstrip("0")
    return len(significant) <= 3 and int(significant or "0") <= 255


def proposals(text: str) -> Iterator[tuple[int, int, str]]:
    """Matches that pass the rules of their kind; matches that fail are dropped and not tried again elsewhere."""
    for start, end in emails(text):
        yield start, end, "email"
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            yield *m.span(), "ip"
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield *m.span(), "card"
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield *m.span(), "phone"
    for m in IBAN.finditer(text):
        if 15 <= len(code := m[0].replace(" ", "")) <= 34 and mod_97(code):
            yield *m.span(), "iban"
    for m in SSN.finditer(text):
        yield *m.span(), "ssn"


def score(text: str, start: int, end: int, kind: str) -> float:
    near = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS]}".lower()
    context = 0.3 * any(word in near for word in FOR[kind]) - 0.3 * any(word in near for word in AGAINST)
    return round(min(1.0, max(0.0, PRIOR[kind] + CHECKSUM.get(kind, 0.0) + context)), 2)


def spans_of(text: str | None) -> list[dict]:
    found = []
    for start, end, kind in proposals(text or ""):
        points = score(text, start, end, kind)
        if kind in BASE_KINDS or points >= KEPT_SCORE:
            found.append({"start": start, "end": end, "kind": kind, "score": points})
    return sorted(found, key=lambda span: (span["start"], KINDS.index(span["kind"])))


def find_personal_data(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (start, end, kind, score) in page order.

    Spans of the base kinds (email, ip, card, phone) are always kept; added kinds (iban, ssn) from a score of 0.6.
    A null or empty text has no spans; a null id is carried; repeated rows each give a row; other columns are ignored.
    One pass over the rows, without a shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = pa.array([spans_of(text.as_py()) for text in batch.column(1)], _SPANS)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["doc_id", "spans"])

    rows = df.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<{SPAN}>")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts per base kind, the SHA-256 of the base spans, and all spans as text."""
    spans = F.col("spans")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = of(*BASE_KINDS)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
