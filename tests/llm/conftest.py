"""Small documents with the cases that each operator must define."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
    "rep long, bucket long, _row long, found string, window string, length long, `key` string, item_id long"
)


def prose(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows() -> list[tuple]:
    base = prose(1, 300)
    near = list(base)
    near[150] = "changed"
    chain = list(near)
    chain[20], chain[280] = "other", "words"
    passage = prose(2, 60)
    texts = [
        (0, " ".join(base)), (1, None), (2, ""), (3, " \n\t "), (4, " ".join(base).upper()), (5, " ".join(near)),
        (6, " ".join(chain)), (6, " ".join(chain)), (7, "one two"), (8, "One  Two"), (9, "one"),
        (10, " ".join(prose(3, 80) + passage + prose(4, 70))), (11, " ".join(prose(5, 33) + passage + prose(6, 21))),
        (12, " ".join(passage + prose(7, 200))), (13, "Straße ÉTÉ 世界 🙂 it's  I'll\r\n\n x"), (14, "x" * 30_000),
        (15, "7 " * 20_000), (None, " ".join(base)), (None, None),
        (16, "mail a.b+c@ex-ample.co.uk or x@y; 10.0.0.255 300.1.1.1; 4111 1111 1111 1111; +44 (20) 7946-0958"),
    ]
    return [(i, t, None if i == 3 else "en", "hot", len(t or ""), 1.0, True, 1, 2, 3, "f", "w", 4, "k", 5) for i, t in texts]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in rows()]
