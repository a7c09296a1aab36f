"""Repair of conversations against a plain search over edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest

from rentlens.llm import conversations, queries

SMALL = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    """conv_id to its rows after damage, in order."""
    found: dict = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for kept in found.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    return found


def plain_repair(rows):
    """The report of one conversation by a search over all edits with strings as initials."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def follows(out, initial):
        return {"s": out == "", "u": out in ("", "s", "a"), "a": out == "u"}.get(initial, False)

    @cache
    def best(i, out, inserts):
        """Least (cost, initials, repaired roles) of what is left, after output that ends in `out`."""
        options = [(0, "", ())] if i == len(rows) and out in ("", "a") else []
        if inserts < 4:
            for role in ("user", "assistant"):
                if follows(out, role[0]):
                    cost, initials, left = best(i, role[0], inserts + 1)
                    options.append((cost + 5, "I" + initials, ((role, ""), *left)))
        if i < len(rows):
            cost, initials, left = best(i + 1, out, 0)
            options.append((cost + 2, "D" + initials, left))
            if faults[i] not in ("blank", "duplicate"):
                _, own, text = rows[i]
                extra = 5 * (faults[i] == "truncated")
                for letter, role, price in (("K", own, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if follows(out, role[:1]):
                        cost, initials, left = best(i + 1, role[:1], 0)
                        options.append((cost + price + extra, letter + initials, ((role, text), *left)))
        return min(options, default=(10**9, "", ()))

    cost, audit, repaired = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
    }


def expected(rows):
    return {conv: plain_repair(kept) for conv, kept in plain_damage(rows).items()}


def reported(frame):
    names = [*conversations.COUNTS, "audit", "repaired_sha256"]
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: {n: r[n] for n in names} for r in rows}


def made(seed, conversations_, most):
    rng, rows = random.Random(seed), []
    for conv in range(conversations_):
        turn = rng.randrange(-2, 3)
        for _ in range(rng.randrange(0, most)):
            turn += rng.choice([0, 1, 1, 1, 1, 2])
            text = rng.choice(["Yes.", "No!", "why?", "cut off", "", " \t", "Ä. ", "so  \n", None, "x" * 30 + "."])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            rows.append((conv if conv % 7 else None, None if rng.random() < 0.05 else turn, role, text))
    rng.shuffle(rows)
    return rows


SHAPE = "conv_id long, turn long, role string, text string, fault int, kind int, audit string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SHAPE).repartition(parts)


@pytest.mark.parametrize("seed", range(3))
def test_repairs_are_cheapest_and_first(spark, seed):
    rows = made(seed, 120, 9)
    found = conversations.Repair(conversations.damaged(frame(spark, rows)))
    assert reported(found.report) == expected(rows)


@pytest.mark.parametrize("block", [1, 2, 7])
def test_long_conversations_are_joined_from_blocks(spark, block):
    rows = made(11, 12, 60)
    found = conversations.Repair(conversations.damaged(frame(spark, rows, 5)), block_rows=block)
    want = expected(rows)
    assert reported(found.report) == want
    texts: dict = {}
    for m in sorted(found.messages().collect(), key=lambda m: (m["conv_id"] is not None, m["conv_id"], m["place_turn"] is not None, m["place_turn"], bytes(m["place_digest"] or b""), m["place_no"] or 0, m["position"])):
        texts.setdefault(m["conv_id"], []).append(f"{m['role']}:{m['text']}")
    for conv, report in want.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == report["repaired_sha256"]


def test_repeats_over_block_ends(spark):
    rows = [(1, t, "user", "same.") for t in range(40)] + [(1, 3, "user", "same.")] * 30 + [(2, None, "assistant", "a.")] * 25
    found = conversations.Repair(conversations.damaged(frame(spark, rows)), block_rows=4)
    assert reported(found.report) == expected(rows)


def test_rows_as_they_are(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hello?"), (2, 5, "assistant", "Well"), (3, None, None, None)]
    found = conversations.repair(frame(spark, rows))
    got = reported(found.report)
    assert (got[1]["audit"], got[1]["cost"]) == ("KKR", 1)
    assert (got[2]["audit"], got[2]["cost"], got[2]["truncated"]) == ("D", 2, 1)
    assert (got[3]["audit"], got[3]["blank"], got[3]["gaps"]) == ("D", 1, 0)
    kept = [(m["role"], m["text"]) for m in sorted(found.messages().collect(), key=lambda m: m["position"])]
    assert kept == [("system", "Be kind."), ("user", "Hi."), ("assistant", "Hello?")]


def test_no_conversations(spark):
    assert conversations.Repair(conversations.damaged(frame(spark, []))).report.collect() == []


def test_query_and_sql_agree_with_the_search(spark):
    table = queries.table(spark, SMALL, "conversations")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    want = expected(rows)
    assert reported(queries.op11_conversation_repair(spark, SMALL)) == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cursor = db.execute(queries.ORACLES["op11_conversation_repair"])
    names = [d[0] for d in cursor.description]
    got = {r[names.index("conv_id")]: dict(zip(names, r, strict=True)) for r in cursor.fetchall()}
    assert {c: {k: v for k, v in r.items() if k != "conv_id"} for c, r in got.items()} == want
