"""Personal data: patterns propose spans, checksums confirm, context moves the score.

Kinds in order: email, ip, card, phone, iban, ssn. The first four are found by fixed
patterns and are kept whatever their score; of the others, spans that pass their check
and whose score, with context words near them, reaches the limit. Spans are code points,
end exclusive; each kind is searched from the left without overlaps, and spans of
different kinds may overlap.

Defined results: null text is empty and has no spans. Repeated rows give repeated
results. Patterns take time in proportion to the text, however long its runs are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = 4
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
LIMIT = 0.5
NEAR = 40

# The local part, the domain, and the other patterns of the contract. A run
# is entered at its beginning only, and what a run has taken it does not give back where
# that could not lead to a match; the matches are the same.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_WORDS = re.compile(r"[^\W\d_]+")
#: Score without context, and words near a span that raise it.
PRIOR = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "server", "host"},
    "card": {"card", "visa", "credit", "payment"},
    "phone": {"phone", "call", "tel", "mobile", "fax"},
    "iban": {"iban", "account", "bank", "transfer"},
    "ssn": {"ssn", "social", "security", "insurance"},
}
RAISE = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod_97(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back to the start of its local part and on over its domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def _phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _iban(text: str) -> bool:
    packed = text.replace(" ", "")
    return 15 <= len(packed) <= 34 and mod_97(packed)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest end at the end of a word that passes the check, since words in capitals
    may follow the number; the search goes on from there."""
    at = 0
    while found := _IBAN.search(text, at):
        start, last = found.span()
        ends = (e for e in range(last, start, -1) if (e == last or text[e] == " ") and _iban(text[start:e]))
        end = next(ends, None)
        if end is not None:
            yield start, end
        at = start + 1 if end is None else end


_PROPOSED = [("ip", _IP, _ip), ("card", _CARD, _card), ("phone", _PHONE, _phone), ("ssn", _SSN, lambda _: True)]


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    helped = not CONTEXT[kind].isdisjoint(w.lower() for w in _WORDS.findall(near))
    return min(1.0, PRIOR[kind] + RAISE * helped)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of all spans, by start and then by kind."""
    text = text or ""
    found = [("email", a, b) for a, b in _emails(text)] + [("iban", a, b) for a, b in _ibans(text)]
    for kind, pattern, holds in _PROPOSED:
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m[0])]
    scored = [(kind, a, b, _score(text, kind, a, b)) for kind, a, b in found]
    kept = [s for s in scored if s[3] >= LIMIT or KINDS.index(s[0]) < BASE_KINDS]
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None) -> str | None:
    """The text with a mark in place of each span; overlapping spans share one mark."""
    if text is None:
        return None
    out, done = [], 0
    for kind, start, end, _ in spans(text):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find(docs: DataFrame) -> DataFrame:
    """doc_id and found: the spans of every row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, found {SPAN}")


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` replaced by marks; other columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            texts = pa.array([redacted(t) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, batch.schema.field(place), texts)

    return docs.mapInArrow(run, docs.schema)
