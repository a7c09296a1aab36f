"""Spans against the contract's patterns as they are written."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from rentlens.llm import pii

WRITTEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text: str) -> list[str]:
    found = []
    for order, (kind, pattern) in enumerate(WRITTEN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and doubled % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def base(text: str) -> list[str]:
    return [f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(text) if k in WRITTEN]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_are_those_of_the_patterns(seed):
    rng = random.Random(seed)
    parts = ["a.b", "@", "x-y.co", ".", "1.2.3.4", "256", "12", " ", "-", "+4", "4111 1111 1111 1111", "(020)", "é", "世", "+1 202-555-0123", "4" * 12]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 12)))
        assert base(text) == brute(text), text


def test_checksums_and_context():
    kinds = lambda text: [s[0] for s in pii.spans(text)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32.") == ["iban"]
    assert "iban" not in kinds("IBAN GB82 WEST 1234 5698 7654 33.")
    assert "ssn" in kinds("social security 123-45-6789") and "ssn" not in kinds("part 123-45-6789")


def test_words_in_capitals_may_follow_an_iban():
    ibans = lambda text: [text[a:b] for k, a, b, _ in pii.spans(text) if k == "iban"]
    spanish, german, british = "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    for after in ("", " FOR", " IS", " BANK", " FOR THE", " A", ".", " IBAN " + british):
        assert ibans(f"IBAN {spanish}{after}")[0] == spanish
    assert ibans(f"{spanish} {german} {british} {spanish}") == [spanish, german, british, spanish]
    assert ibans("AB12 CD34 " + german) == [german]
    assert ibans(spanish[:-1] + "3 FOR") == [] == ibans(spanish + "Q")


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "@" * 100_000, "A1 " * 100_000):
        pii.spans(text)


def test_find_and_redact(documents, nothing, texts):
    found = {(r["doc_id"], len(r["found"])) for r in pii.find(documents).collect()}
    assert len(pii.find(documents).collect()) == len(texts)
    assert (1, 0) in found and (2, 0) in found and (16, 4) in found
    assert pii.find(nothing).count() == 0
    out = pii.redact(documents)
    assert out.columns == documents.columns
    changed = {r["doc_id"]: r["text"] for r in out.collect()}
    assert changed[16] == "mail <EMAIL> or x@y; <IP> 300.1.1.1; <CARD>; <PHONE>"
    assert changed[1] is None and changed[2] == ""


def test_query_joins_spans(spark):
    from rentlens.llm import queries

    rows = queries.op3_pii(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    for row in rows:
        want = brute(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(row["spans"].split(",")) | {""}
