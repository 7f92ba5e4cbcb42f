"""Web archives: write pages as WARC records, read archives and salvage damaged ones.

Writing. Each page is a record. Of pages with equal payloads of at least ``min_bytes``
the one with the largest page_id (and url) is a response, the others are revisits that
refer to it and carry no payload. Copies of a payload are merged on each task, so each is
shuffled and written once. Records are gzip members of their own, in files that Spark's
text writer commits; the separator it puts behind each row is an empty gzip member.

Reading. A record must have a version line, headers that parse, a block of the declared
length and digests that match; a gzip member must also decompress to its checksum. Behind
a failed check the reader searches for the next gzip member or version line that begins
a valid record, goes on from there, and logs the bytes between as a gap. A member that is
damaged, or holds a damaged record, is inflated as far as it goes and searched in the same
way: its valid records are kept, and its gaps have their place in the inflated bytes too.
Where the compressed bytes are wrong, only records count that a digest of their own vouches
for. A record alone in its member is that member: it needs the member's checksum.

A null html is an empty payload. Pages with a null page_id are archived without one; they
refer to others, or are referred to, by record only. Pages that repeat id, url and payload
are records of their own, of which at most one is a response if the payload is long enough.
A null url is replaced by a name of the page. An empty table gives an empty archive. Other
columns are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
SEPARATOR = gzip.compress(b"", mtime=0)
RECORDS_PER_FILE = 20_000

_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/(?:0\.\d+|1\.[01])\r\n")
_HEADER = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*(.*)")
_FEED = 1 << 16

RECORDS = (
    "file string, start long, end long, record_type string, record_id string, uri string, page_id long, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary"
)
GAPS = "file string, start long, end long, reason string, inside_start long, inside_end long"


# Writing


def record(
    kind: str, page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None,
    payload: bytes, copy: int = 0,
) -> bytes:
    """The bytes of a record; ``size`` and ``digest`` (hex SHA-1) are those of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + payload
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{_record_id(page_id, digest, copy, kind)}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines.append(f"WARC-Refers-To: <{_record_id(refers_to, digest, 0, 'response')}>")
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _record_id(page_id: int | None, digest: str, copy: int, kind: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{kind}:{page_id}:{copy}:{digest}").urn


def records_of(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The records to write for pages (page_id, url, html)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    nobody = F.lit(None).cast("long")
    short = rows.where(F.col("size") < min_bytes).select(
        F.lit("response").alias("kind"), "page_id", "url", "size", "digest",
        nobody.alias("refers_to"), "payload", F.lit(0).alias("copy"),
    )
    long = rows.where(F.col("size") >= min_bytes)
    leads = long.groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("lead"), F.first("size").alias("size"), F.first("payload").alias("payload")
    )
    responses = leads.select(
        F.lit("response").alias("kind"), "lead.page_id", "lead.url", "size", "digest",
        nobody.alias("refers_to"), "payload", F.lit(0).alias("copy"),
    )
    copies = long.groupBy("digest", "size", "page_id", "url").agg(F.count("*").cast("int").alias("n"))
    leads = long.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("lead"), F.count("*").alias("all"))
    again = copies.join(leads.where("all > 1"), "digest")
    own = F.struct("page_id", "url").eqNullSafe(F.col("lead"))
    again = again.withColumn("n", F.col("n") - own.cast("int")).where("n > 0")
    revisits = again.select(
        F.lit("revisit").alias("kind"), "page_id", "url", "size", "digest",
        F.col("lead.page_id").alias("refers_to"), F.lit(None).cast("binary").alias("payload"),
        F.explode(F.sequence(F.lit(1), "n")).alias("copy"),
    )
    return short.unionByName(responses).unionByName(revisits)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write pages as archives below ``path``."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pylist()
                out = [
                    gzip.compress(
                        record(
                            r["kind"], r["page_id"], r["url"], r["size"], r["digest"], r["refers_to"],
                            r["payload"] or b"", r["copy"],
                        ),
                        mtime=0,
                    )
                    for r in rows
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    written = records_of(pages, min_bytes).mapInArrow(members, "value binary")
    writer = written.select(F.col("value").cast("string")).write.mode("errorifexists")
    writer = writer.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


# Reading


class Damaged(ValueError):
    """What begins here is not a valid record."""


class Gap(str):
    """The reason of a gap, and its place in the inflated bytes if it begins behind others of its member."""

    inside: tuple[int | None, int | None] = (None, None)

    @classmethod
    def within(cls, reason: str, start: int, end: int) -> Gap:
        gap = cls(reason)
        gap.inside = (start, end)
        return gap


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    @property
    def full_size(self) -> int:
        """Bytes of the payload, of a revisit those of the payload that it stands for."""
        if self.headers.get("warc-type") != "revisit":
            return len(self.payload)
        declared = _parse_headers(self.block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]).get("content-length", "")
        return int(declared) if declared.isdigit() else 0

    @property
    def vouched(self) -> bool:
        """Whether a digest covers the block; parse_record has compared it."""
        own = self.headers
        names = ["warc-block-digest"] if own.get("warc-type") == "revisit" else ["warc-block-digest", "warc-payload-digest"]
        return any(_hex_digest(own.get(n, "")) for n in names)


def _parse_headers(lines: list[bytes]) -> dict[str, str]:
    headers, last = {}, None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:
            headers[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        match = _HEADER.fullmatch(line)
        if not match:
            raise Damaged("header")
        last = match[1].decode().lower()
        headers[last] = match[2].strip().decode("utf-8", "replace")
    return headers


def _hex_digest(declared: str) -> str | None:
    """A declared SHA-1 as hex; null for other kinds."""
    name, _, value = declared.partition(":")
    if name.lower() != "sha1":
        return None
    try:
        raw = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    except ValueError:
        raise Damaged("digest") from None
    return raw.hex()


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at a place, and where it ends."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("version")
    close = data.find(b"\r\n\r\n", at)
    if close < 0:
        raise Damaged("header")
    headers = _parse_headers(data[version.end() : close].split(b"\r\n"))
    declared = headers.get("content-length", "")
    if not declared.isdigit() or "warc-type" not in headers:
        raise Damaged("header")
    start, end = close + 4, close + 4 + int(declared)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("length")
    found = Record(headers, data[start:end])
    if "warc-block-digest" in headers:
        expected = _hex_digest(headers["warc-block-digest"])
        if expected and expected != hashlib.sha1(found.block).hexdigest():
            raise Damaged("block digest")
    if "warc-payload-digest" in headers and headers["warc-type"] != "revisit":
        expected = _hex_digest(headers["warc-payload-digest"])
        if expected and expected != hashlib.sha1(found.payload).hexdigest():
            raise Damaged("payload digest")
    return found, end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """What the gzip member at a place inflates to, where it ends, and what is wrong with it."""
    inflate, out, fed = zlib.decompressobj(31), [], at
    while not inflate.eof:
        if fed >= len(data):
            return b"".join(out), fed, "member cut off"
        before, chunk = inflate.copy(), data[fed : fed + _FEED]
        try:
            out.append(inflate.decompress(chunk))
        except zlib.error:
            out.append(_until(before, chunk, None)[0])
            return b"".join(out), fed, "member"
        fed += len(chunk)
    return b"".join(out), fed - len(inflate.unused_data), ""


def _until(inflate, chunk: bytes, size: int | None) -> tuple[bytes, int]:
    """What a chunk inflates to before an error or until so many bytes, and how much of it that takes."""
    out, got, used = [], 0, 0
    step = len(chunk)
    while step and used < len(chunk):
        trial = inflate.copy()
        try:
            found = trial.decompress(chunk[used : used + step])
            over = size is not None and got + len(found) >= size
        except zlib.error:
            over = True
        if not over:
            inflate, got, used = trial, got + len(found), min(used + step, len(chunk))
            out.append(found)
        elif step == 1:
            return b"".join(out), used
        else:
            step = (step + 1) // 2
    return b"".join(out), used


def _taken(data: bytes, at: int, size: int) -> int:
    """Behind the compressed bytes that the first ``size`` bytes of the member at a place are made from."""
    inflate, got, fed = zlib.decompressobj(31), 0, at
    while True:
        before, chunk = inflate.copy(), data[fed : fed + _FEED]
        try:
            found = len(inflate.decompress(chunk))
        except zlib.error:
            found = size - got
        if got + found >= size:
            return fed + _until(before, chunk, size - got)[1] + 1
        got, fed = got + found, fed + len(chunk)


def _found_at(data: bytes, at: int) -> tuple[list[Record | Gap], int, Gap | None]:
    """The record, or a member's records and gaps, that begin at a place, their end, and the gap behind."""
    if data[at : at + 3] != _MAGIC:
        found, end = parse_record(data, at)
        return [found], end, None
    content, end, wrong = _member(data, at)
    found, inside, gap, reason, behind = [], 0, None, "", 0
    while inside < len(content):
        try:
            one, after = parse_record(content, inside)
            if wrong == "member" and not one.vouched:
                raise Damaged(wrong)
        except Damaged as error:
            if gap is None:
                gap, reason = inside, str(error)
            version = _VERSION.search(content, inside + 1)
            inside = version.start() if version else len(content)
            continue
        if gap is not None:
            found.append(Gap.within(reason, gap, inside))
            gap = None
        found.append(one)
        inside = behind = after
    if wrong:
        if not behind or (len(found) == 1 and behind == len(content)):
            raise Damaged(wrong)
        # What follows the last valid record is searched, and logged, as bytes of the file.
        end = _taken(data, at, behind)
        return found, min(end, len(data) - 1), Gap.within(wrong, behind, len(content))
    if gap is not None:
        if not behind:
            raise Damaged(reason)
        found.append(Gap.within(reason, gap, len(content)))
    return found, end, None


class _Starts:
    """Where the next member or version line may begin.

    A place is looked for again only once it is passed, so all searches read the data once.
    """

    def __init__(self, data: bytes):
        self.data, self.member, self.version = data, -1, -1

    def next(self, at: int) -> int:
        if self.member < at:
            member = self.data.find(_MAGIC, at)
            self.member = member if member >= 0 else len(self.data)
        if self.version < at:
            version = _VERSION.search(self.data, at)
            self.version = version.start() if version else len(self.data)
        return min(self.member, self.version)


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | Gap]]:
    """(start, end, record) of what is valid, (start, end, reason) of the gaps between."""
    starts, at, gap, reason = _Starts(data), 0, None, Gap()
    while at < len(data):
        try:
            records, end, lost = _found_at(data, at)
        except Damaged as error:
            if gap is None:
                gap, reason = at, Gap(error)
            at = starts.next(at + 1)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        for found in records:
            yield at, end, found
        if lost is not None:
            gap, reason = end, lost
            end = starts.next(end)
        at = end
    if gap is not None:
        yield gap, len(data), reason


def _number(text: str | None) -> int | None:
    """A number in the range of a long."""
    number = int(text) if text and re.fullmatch(r"-?\d{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> tuple[DataFrame, DataFrame]:
    """The records of all archives below ``path``, and the log of quarantined gaps.

    A task holds one archive at a time. Without ``payload`` that column is null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.col("length") > 0).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch], gaps: bool) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in (GAPS if gaps else RECORDS).split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                file, rows, size = batch.column(0)[i].as_py(), [], 0
                for start, end, found in salvage(batch.column(1)[i].as_py()):
                    if gaps != isinstance(found, str):
                        continue
                    rows.append((file, start, end, found, *found.inside) if gaps else (file, start, end, *_columns(found, payload)))
                    size += 0 if gaps else len(found.block)
                    if size >= 1 << 22 or len(rows) >= 2_000:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = {"start": pa.int64(), "end": pa.int64(), "inside_start": pa.int64(), "inside_end": pa.int64(), "page_id": pa.int64(), "refers_to": pa.int64(),
                 "payload_bytes": pa.int64(), "payload": pa.binary()}
        columns = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def records(batches):
        return parse(batches, False)

    def gaps(batches):
        return parse(batches, True)

    return files.mapInArrow(records, RECORDS), files.mapInArrow(gaps, GAPS)


def _columns(found: Record, payload: bool) -> tuple:
    own = found.headers
    digest = _hex_digest(own.get("warc-payload-digest", "")) or hashlib.sha1(found.payload).hexdigest()
    return (
        own["warc-type"], own.get("warc-record-id"), own.get("warc-target-uri"), _number(own.get("x-page-id")),
        _number(own.get("x-refers-to-page-id")), found.full_size, digest,
        found.payload if payload else None,
    )
