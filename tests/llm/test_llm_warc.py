"""Archives written and read back, whole and damaged."""

from __future__ import annotations

import collections
import gzip
import hashlib
import random
import shutil
import zlib

import pytest

from rentlens.llm import queries, warc

SMALL = "/root/testdata/sf0.001"
SHAPE = "page_id long, url string, html string, digest string, `row` long, kind string, type string"


def pages():
    long = "é" * 700
    return [
        (1, "http://a/1", long), (2, "http://a/2", long), (9, "http://a/9", long), (3, None, None), (4, "http://a/\r\n4", ""),
        (5, "http://a/5", "short"), (6, "http://a/6", "short"), (7, "u", "x" * 999), (8, "u", "x" * 999), (None, "u", "y" * 1000),
        (10, "u", "y" * 1000), (11, "u", "WARC/1.1\r\n\r\n" * 200), (12, "u", "z" * 5000), (12, "u", "z" * 5000), (12, "v", "z" * 5000),
        (13, "u", "\x1f\x8b\x08" * 500), (14, "u", "long " * 5_000_000), (15, "u", "long " * 5_000_000),
    ]


def expected(rows):
    found, groups = [], collections.defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for place, page_id in enumerate(ids):
            again = len(payload) >= 1000 and place < len(ids) - 1
            found.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", ids[-1] if again else None))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "k", "t") for r in rows], SHAPE).repartition(3)


def listed(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_round_trip(spark):
    assert listed(warc.round_trip(frame(spark, pages()))) == expected(pages())


def test_no_pages(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []


def test_query(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in queries.table(spark, SMALL, "pages").collect()]
    assert listed(queries.op13_warc(spark, SMALL)) == expected(rows)


def test_files_are_gzip_of_single_members(spark, tmp_path):
    warc.write(frame(spark, pages()), str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("part-*"))
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert plain.count(b"WARC-Type: response\r\n") == sum(r[3] == "response" for r in expected(pages()))
    found = warc.read(spark, str(tmp_path / "a")).collect()
    assert {r["kind"] for r in found} == {"record"}
    texts = {r["payload"].decode() for r in found if r["type"] == "response"}
    assert texts == {html or "" for _, _, html in pages()}


def records(n, seed=0):
    rng = random.Random(seed)
    return [warc.page_record("0" * 32, i, f"u{i}", p := bytes(rng.choices(b"abc <>\n\r", k=rng.randrange(3000))), hashlib.sha1(p).digest(), i, None, None) for i in range(n)]


def whole(data):
    found = list(warc.salvage(data))
    return [r for r in found if not isinstance(r, tuple)], [g for g in found if isinstance(g, tuple)]


def covered(data, got, gaps):
    """Records and gaps touch each other and fill the file."""
    spans = sorted({(r.begin, r.begin + r.size) for r in got} | {(a, b) for a, b, _ in gaps})
    at = 0
    for begin, end in spans:
        assert begin == at and end > begin
        at = end
    assert at == len(data)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_salvage_finds_every_later_record(seed, packed):
    rng = random.Random(seed)
    parts = [warc.member(r) + b"\0" if packed else r for r in records(20, seed)]
    hurt = sorted(rng.sample(range(20), 4))
    pieces = []
    for i, part in enumerate(parts):
        if i == hurt[0]:
            part = part[: len(part) // 2]  # cut off
        elif i == hurt[1]:
            at = len(part) - (12 if packed else 5)
            part = part[:at] + bytes([part[at] ^ 1]) + part[at + 1 :]  # one bit
        elif i == hurt[2]:
            part = rng.randbytes(300) + warc.MEMBER + rng.randbytes(200)  # overwritten, with what looks like a member
        elif i == hurt[3]:
            part = b""
        pieces.append(part)
    data = b"".join(pieces)
    got, gaps = whole(data)
    assert [r.headers["x-page-id"] for r in got] == [str(i) for i in range(20) if i not in hurt]
    covered(data, got, gaps)
    assert 2 <= len(gaps) <= 3 and all(reason for _, _, reason in gaps)


def test_mixed_files_and_other_gzip():
    a, b, c, d = records(4)
    packer = zlib.compressobj(9, zlib.DEFLATED, 31)
    both = packer.compress(b + c) + packer.flush()
    data = b"junk" + a + both + gzip.compress(b"no record") + warc.member(d) + b"\0" + b"tail"
    got, gaps = whole(data)
    assert [r.headers["x-page-id"] for r in got] == ["0", "1", "2", "3"]
    assert len(gaps) == 3 and gaps[0][:2] == (0, 4) and gaps[2][1] == len(data)
    assert list(warc.salvage(b"")) == []


def test_damage_is_logged_and_the_rest_is_read(spark, tmp_path):
    warc.write(frame(spark, pages()).coalesce(1), str(tmp_path / "a"))
    shutil.copytree(tmp_path / "a", tmp_path / "b", ignore=shutil.ignore_patterns(".*", "_*"))
    (file,) = (tmp_path / "b").glob("part-*")
    data = bytearray(file.read_bytes())
    before = [r for r in warc.read(spark, str(tmp_path / "b")).collect() if r["type"] == "response"]
    lost = next(r for r in before if r["page_id"] == 9)
    data[lost["begin"] + lost["size"] // 2] ^= 255
    file.write_bytes(bytes(data))
    found = warc.read(spark, str(tmp_path / "b")).cache()
    (gap,) = warc.gaps(found).collect()
    assert (gap["begin"], gap["size"]) == (lost["begin"], lost["size"]) and gap["reason"]
    left = [r for r in listed(warc.pages_of(found))]
    assert len(left) == len(pages()) - 1
    # Revisits of the lost response keep the digest they were written with.
    orphans = [r for r in left if r[0] in (1, 2)]
    assert all(r[1] is None and r[4] is None and r[2] == hashlib.sha1(("é" * 700).encode()).hexdigest() for r in orphans)
