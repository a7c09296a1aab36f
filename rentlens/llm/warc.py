"""Web archives: records written with revisits of equal payloads, and a reader that salvages.

`write` gives every row of pages a record. Of rows with equal payloads of at least
`LEAST_SHARED` bytes, the one of largest page_id is a response and the others are revisits
without the payload; rows of one id that are equal are told apart by their place. Every
record is a gzip member of its own. Spark's committer writes the files, so lost tasks leave
no half archives. Its text format ends a row with a separator: the last byte of a member,
the high byte of its length, is that separator, zero below 16 MiB; larger members are
followed by an empty one.

`read` takes archives of single members, of larger members, and plain ones. Members are
checked by their checksum; records by version line, lengths and digests. After a failed
check it goes on at the next member or version line from which a whole record can be read,
and logs the bytes between as a gap with the reason. A file is one row of the reader, so a
file should stay below the 2 GB of Spark's binary source; files written here hold what one
task has read.

Defined results: null html is an empty payload. Null ids count as smallest and stay null. A
revisit whose response is lost has no `refers_to` and no length. An empty table gives no
records, and so does an empty file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.operators.spool import spool, spool_folder

LEAST_SHARED = 1000
# Fixed values of the archive format.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STAMP = "2024-01-01T00:00:00Z"
_VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
_END = b"\r\n\r\n"
#: Compressed bytes that are read at a time.
STEP = 1 << 16

ROW = (
    "path string, kind string, begin long, size long, reason string, type string, record_id string, refers_id string, "
    "uri string, page_id long, payload binary, payload_bytes long, payload_digest string"
)


# --- writing -----------------------------------------------------------------------------

def prepared(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, type and the number of the response a revisit is of.

    The rows are written once, with a number each, because ties need rows to be told apart.
    Only digests that occur more than once are joined back.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = spool(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
        .withColumns({"digest": F.sha1("payload"), "row": F.monotonically_increasing_id()})
    )
    shared = (
        rows.filter(F.length("payload") >= LEAST_SHARED).groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "row", "url")).alias("kept"))
        .filter("n > 1").select("digest", F.col("kept.row").alias("response"), F.col("kept.url").alias("response_url"))
    )
    # Equal bytes below the limit cannot have the digest of longer ones.
    met = rows.join(spool(shared), "digest", "left")
    return met.withColumn("is_revisit", F.coalesce(F.col("response") != F.col("row"), F.lit(False)))


def record_id(archive: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(archive), str(row))}>"


def digest_text(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record with its lengths and the digest of its block."""
    lines = [*fields, ("WARC-Block-Digest", digest_text(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return head + b"\r\n" + block + _END


def plain_line(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def page_record(archive: str, page_id: int | None, url: str | None, payload: bytes, sha1: bytes, row: int, response: int | None, response_url: str | None) -> bytes:
    """The record of a page; with the number of a response, a revisit of that."""
    fields = [
        ("WARC-Type", "revisit" if response is not None else "response"), ("WARC-Record-ID", record_id(archive, row)),
        ("WARC-Date", STAMP), ("WARC-Target-URI", plain_line(url or "")), ("WARC-Payload-Digest", digest_text(sha1)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if response is not None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(archive, response)),
            ("WARC-Refers-To-Target-URI", plain_line(response_url or "")), ("WARC-Refers-To-Date", STAMP),
        ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(fields, head if response is not None else head + payload)


def member(content: bytes) -> bytes:
    """A gzip member without its last byte, which is zero; a large one is followed by an
    empty member, since its own last byte is not."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(content) + packer.flush()
    if len(content) & 0xFFFFFFFF >= 1 << 24:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed += packer.flush()
    return packed[:-1]


def write(pages: DataFrame, folder: str) -> None:
    """Archives of `pages` (page_id, url, html) in `folder`, a file for each task."""
    archive = str(uuid.uuid4())
    columns = ["page_id", "url", "payload", "digest", "row", "response", "response_url", "is_revisit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = record(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", STAMP), ("Content-Type", "application/warc-fields")],
            b"format: WARC File Format 1.1\r\n",
        )
        for batch in batches:
            packed = [member(info)] if info else []
            info = b""
            for page_id, url, payload, sha1, row, response, response_url, is_revisit in zip(*(batch.column(c) for c in columns), strict=True):
                packed.append(
                    member(
                        page_record(
                            archive, page_id.as_py(), url.as_py(), payload.as_py(), bytes.fromhex(sha1.as_py()), row.as_py(),
                            response.as_py() if is_revisit.as_py() else None, response_url.as_py(),
                        )
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["value"])

    records = prepared(pages).select(*columns).mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(folder)


# --- reading -----------------------------------------------------------------------------

class Unsound(Exception):
    """Why bytes are not a record."""


@dataclass
class Record:
    """A record as read; `size` is what it takes in the file, compressed or not."""

    headers: dict[str, str]
    block: bytes
    begin: int = 0
    size: int = 0
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""

    @property
    def type(self) -> str:
        return self.headers.get("warc-type", "")


def salvage(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """Records of an archive in order; and (begin, end, reason) of the bytes between that
    are none."""
    at, reason, lost = 0, "", None
    while at < len(data):
        try:
            found, end = entry(data, at)
        except Unsound as why:
            if lost is None:
                lost, reason = at, str(why)
            at = next_start(data, at + 1)
            continue
        if lost is not None:
            yield lost, at, reason
            lost = None
        yield from found
        at = end
    if lost is not None:
        yield lost, len(data), reason


def next_start(data: bytes, at: int) -> int:
    """Where the next member or version line may begin."""
    member_at, line = data.find(MEMBER, at), _VERSION_LINE.search(data, at)
    return min([member_at] * (member_at >= 0) + ([line.start()] if line else []), default=len(data))


def entry(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the member at a place, or the plain record there, and its end."""
    if not data.startswith(MEMBER, at):
        found, end = parsed(data, at)
        found.begin, found.size = at, end - at
        return [found], end
    content, end = inflated(data, at)
    inside, records = 0, []
    while inside < len(content):
        found, inside = parsed(content, inside)
        found.begin, found.size = at, end - at
        records.append(found)
    return records, end


def inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at a place, with its checksum right, and its end."""
    opened, parts, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not opened.eof:
            if at >= len(data):
                raise Unsound("member is cut off")
            parts.append(opened.decompress(view[at : at + STEP]))
            at = min(len(data), at + STEP)
    except zlib.error as error:
        raise Unsound("member is damaged") from error
    return b"".join(parts), at - len(opened.unused_data)


def parsed(data: bytes, at: int) -> tuple[Record, int]:
    """The record whose version line is at a place, checked, and where it ends."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise Unsound("no version line")
    end = data.find(_END, line.end() - 2)
    if end < 0:
        raise Unsound("header has no end")
    headers = header_lines(data[line.end() : end])
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Unsound("no length")
    begin = end + len(_END)
    stop = begin + int(length)
    if data[stop : stop + len(_END)] != _END:
        raise Unsound("record does not end where its length says")
    found = Record(headers, data[begin:stop])
    if not same_digest(headers.get("warc-block-digest"), found.block):
        raise Unsound("block has another digest")
    if headers.get("content-type", "").startswith("application/http"):
        head, _, found.payload = found.block.partition(_END)
        found.http = header_lines(head.partition(b"\r\n")[2])
    else:
        found.payload = found.block
    if found.type == "response" and not same_digest(headers.get("warc-payload-digest"), found.payload):
        raise Unsound("payload has another digest")
    return found, stop + len(_END)


def header_lines(data: bytes) -> dict[str, str]:
    found = {}
    for line in data.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def same_digest(said: str | None, content: bytes) -> bool:
    """Whether content has the digest that is said; digests that are not SHA-1 are not checked."""
    value = sha1_of(said)
    return value is None or value == hashlib.sha1(content).hexdigest()


def sha1_of(said: str | None) -> str | None:
    """Hexadecimal digits of a digest in base 32 or base 16; null if it is no SHA-1."""
    name, _, value = (said or "").partition(":")
    if name.lower() != "sha1":
        return None
    if re.fullmatch(r"[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Rows of kind `record` and `gap` of all files in `folder`: path, begin and size in the
    file; of a gap its reason; of a record type, record_id, refers_id, uri, page_id,
    payload (null unless asked for), payload_bytes and payload_digest (hexadecimal)."""

    def rows(path: str, data: bytes) -> Iterator[tuple]:
        for found in salvage(data):
            if isinstance(found, tuple):
                begin, end, reason = found
                yield (path, "gap", begin, end - begin, reason, *[None] * 8)
                continue
            said = sha1_of(found.headers.get("warc-payload-digest"))
            whole = found.type != "revisit"
            page = found.headers.get("x-page-id", "")
            yield (
                path, "record", found.begin, found.size, None, found.type, found.headers.get("warc-record-id"),
                found.headers.get("warc-refers-to"), found.headers.get("warc-target-uri"),
                int(page) if re.fullmatch(r"-?[0-9]{1,19}", page) else None,
                found.payload if payloads and whole else None, len(found.payload) if whole else None,
                hashlib.sha1(found.payload).hexdigest() if whole else said,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held, weight = [], 0
                for row in rows(path, content.as_py() or b""):
                    held.append(row)
                    weight += 200 + len(row[10] or b"")
                    if weight > 16 << 20:
                        yield _batch(held)
                        held, weight = [], 0
                if held:
                    yield _batch(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(folder)
    return files.select("path", "content").mapInArrow(run, ROW)


_TYPES = [
    pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
    pa.int64(), pa.binary(), pa.int64(), pa.string(),
]
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def gaps(found: DataFrame) -> DataFrame:
    """Quarantined bytes of what was read: path, begin, size, reason."""
    return found.filter("kind = 'gap'").select("path", "begin", "size", "reason")


def pages_of(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every response
    and revisit; length and id of a revisit's response come from that record."""
    records = found.filter("kind = 'record' AND type IN ('response', 'revisit')")
    responses = records.filter("type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("response_page"), F.col("payload_bytes").alias("response_bytes"),
    )
    own = records.filter("type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    )
    again = records.filter("type = 'revisit'").join(responses, "refers_id", "left").select(
        "page_id", F.col("response_bytes").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), F.col("response_page").alias("refers_to"),
    )
    return own.unionByName(again)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of `pages` into the shared folder and list what is read back."""
    spark = pages.sparkSession
    folder = f"{spool_folder(spark)}/archives-{uuid.uuid4().hex}"
    write(pages, folder)
    return pages_of(spool(read(spark, folder, payloads=False)))
