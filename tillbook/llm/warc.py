"""WARC archives of pages: written as files by Spark, and read back by splits with segments reassembled.

Writing. Pages with equal payloads are found by SHA-256; the one with the largest page_id becomes a response
record and the others revisit records that refer to it. A response is an HTTP message in chunked transfer
framing. If it exceeds ``segment_bytes`` it is cut into a first segment and continuation records, which
name the first one's record by WARC-Segment-Origin-ID, bear WARC-Segment-Number, and in the last
WARC-Segment-Total-Length. Records are rows of a text sink whose line end is the blank lines between records.

Reading. The text source splits files at the line that begins a record, so any number of tasks read one
file. Where a block holds that very line, it is shorter than its Content-Length and goes on in the next
row of the split; the writer ends a chunk inside such a line, so its own files never hold one.
Whole records are decoded where they are read. Segments are dealt by their origin, sorted by number and
decoded as a stream, so that a task holds one segment at a time beside the payload that it returns.
"""

import base64
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import drop_at_end, pieces, shared_folder, written
from tillbook.llm.spread import attached

CRLF = b"\r\n"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEDIA_TYPE = "application/http; msgtype=response"
_BETWEEN = "\r\n\r\n"
#: Pages that a task frames at once, and bytes of records that it hands on at once.
ROWS = 64
BATCH_BYTES = 4 << 20


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, content: bytes) -> str:
    """The same for the same page and payload, so that a repeated run writes the same archives."""
    name = hashlib.sha256(f"{page_id}:".encode() + content).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def escaped_uri(uri: str) -> str:
    """Blanks and control characters would end a header."""
    return re.sub(r"[\x00-\x20\x7f<>]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), uri)


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """Chunked transfer framing. A chunk also ends after the first letter of a version line's start, so that no
    block holds the line by which readers part records."""
    out, start, unsafe = [], 0, payload.find(VERSION)
    while start < len(payload):
        end = min(start + chunk_bytes, len(payload))
        if 0 <= unsafe < end:
            end = unsafe + 1
            unsafe = payload.find(VERSION, end)
        out.append(b"%x\r\n%b\r\n" % (end - start, payload[start:end]))
        start = end
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block)]
    return CRLF.join([*lines, b"", block])


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: str | None, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response in one or more segments."""
    digest = hashlib.sha256(payload).digest()
    uri = None if url is None else escaped_uri(url)
    shared = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Page-ID", page_id)]
    first = record_id(page_id, digest)
    payload_digest = ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")
    if refers_to:
        # the URI tells apart the revisits of a page that comes with several
        own = record_id(page_id, digest + b"revisit" + (uri or "").encode())
        headers = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *shared, ("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to), payload_digest]
        yield _record(headers, b"")
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", first), *shared, ("Content-Type", MEDIA_TYPE), payload_digest]
    if len(block) <= segment_bytes:
        yield _record(headers, block)
        return
    starts = range(0, len(block), segment_bytes)
    yield _record([*headers, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for number, start in enumerate(starts[1:], 2):
        total = len(block) if start == starts[-1] else None
        yield _record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, digest + b"%d" % number)), *shared, ("WARC-Segment-Origin-ID", first),
             ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)],
            block[start : start + segment_bytes],
        )


def _batches(records: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about BATCH_BYTES; ``size`` is the place of the field that is weighed."""
    out, held = [], 0
    for record in records:
        out.append(record)
        held += 256 + len(record[size] or b"")
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def write_archives(
    pages: DataFrame, path: str, at_least: int = 0, segment_bytes: int = 1 << 20, chunk_bytes: int = 1 << 16,
    date: str = "1970-01-01T00:00:00Z", compression: str = "none",
) -> None:
    """Write a record for each of the pages (page_id, url, html) to new files in the folder ``path``.

    Of pages with equal payloads of ``at_least`` bytes the one with the largest page_id is a response and the
    others revisit it; rows that share both page_id and payload are alike, so they all are what one is. A null
    page_id is less than any other; payloads that only pages without one have are responses. A null html is an empty
    payload, which is framed and compared like any other; a null url has no header. Rows with one
    page_id and other payloads are separate pages, an empty table writes no record, other columns play no part.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("content", F.when(F.octet_length("html") >= at_least, F.unhex(F.sha2(F.col("html"), 256))))
    same = pages.where("content is not null").groupBy("content").agg(F.max("page_id").alias("target"), F.min("page_id").alias("least"), F.count("page_id").alias("named"), F.count("*").alias("n"))
    same = written(same.where("target is not null and (least < target or named < n)"), "revisit_targets")
    marked = attached(pages, same.select("content", "target"), ["content"], same.select("content", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[bytes]]:
            for piece in pieces(batches, ROWS):
                for page_id, url, html, target in zip(*(c.to_pylist() for c in piece.columns)):
                    refers_to = record_id(target, hashlib.sha256(html).digest()) if target is not None and target != page_id else None
                    for record in page_records(page_id, url, html, refers_to, date, segment_bytes, chunk_bytes):
                        yield (record,)

        yield from _batches(records(), pa.schema([("record", pa.binary())]), 0)

    records = marked.select("page_id", "url", F.col("html").cast("binary"), "target").mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", _BETWEEN).option("compression", compression).text(path)


class Body:
    """The payload of an HTTP message that comes in parts: without its head, and without chunked framing."""

    def __init__(self, http: bool):
        self.rest, self.head, self.chunks, self.left, self.state = b"", b"" if http else None, False, 0, "size"

    def feed(self, data: bytes) -> Iterator[bytes]:
        if self.head is not None:
            self.rest += data
            head, border, data = self.rest.partition(CRLF + CRLF)
            if not border:
                return
            self.head, self.rest = None, b""
            self.chunks = any(re.fullmatch(rb"transfer-encoding:.*\bchunked\s*", line.lower()) for line in head.split(CRLF))
        if not self.chunks:
            yield data
            return
        data, at = self.rest + data, 0
        self.rest = b""
        while at < len(data) and self.state != "end":
            if self.state == "data":
                part = data[at : at + self.left]
                yield part
                at, self.left = at + len(part), self.left - len(part)
                self.state = "data" if self.left else "after"
                continue
            end = data.find(CRLF, at)
            if end < 0:
                self.rest = data[at:]
                return
            line, at = data[at:end], end + 2
            if self.state == "size":
                self.left = int(line.partition(b";")[0], 16)
                self.state = "data" if self.left else "trailer"
            elif self.state == "after":
                if line:
                    raise ValueError("chunk longer than its size")
                self.state = "size"
            elif not line:
                self.state = "end"

    def whole(self) -> bool:
        return self.head is None and (not self.chunks or self.state == "end")


def _headers(head: bytes) -> dict[str, str]:
    fields = (line.partition(b":") for line in head.split(CRLF))
    return {name.strip().lower().decode("latin-1"): value.strip().decode("utf-8", "replace") for name, _, value in fields if name}


_PARSED = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("found_digest", pa.string()), ("error", pa.string()), ("payload", pa.binary()),
    ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("http", pa.bool_()),
])
_READ = _PARSED.names[: _PARSED.names.index("origin")]
_PLACE = {name: k for k, name in enumerate(_PARSED.names)}


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]{1,18}", text) else None


def _decoded(parts: Iterator[bytes], http: bool, keep: bool) -> tuple[int, str, bytes | None, str | None]:
    """Length, digest, the payload if it is kept, and an error or None, of a block that comes in parts."""
    body, digest, size, kept, error = Body(http), hashlib.sha1(), 0, [], None
    try:
        for part in parts:
            for data in body.feed(part):
                digest.update(data)
                size += len(data)
                if keep:
                    kept.append(data)
        error = None if body.whole() else "message cut short"
    except ValueError as problem:
        error = f"unreadable framing: {problem}"
    return size, base64.b32encode(digest.digest()).decode(), b"".join(kept) if keep else None, error


def _bare(digest: str | None) -> str | None:
    return digest.rpartition(":")[2].upper() if digest else None


def _parsed(head: bytes, block: bytes, keep: bool) -> tuple:
    """A row of _PARSED: a whole record decoded, a segment as it is."""
    h = _headers(head)
    kind = h.get("warc-type")
    row = [_number(h.get("warc-page-id")), h.get("warc-record-id"), kind, h.get("warc-target-uri"), _bare(h.get("warc-payload-digest")), h.get("warc-refers-to")]
    http = h.get("content-type", "").startswith("application/http")
    number = _number(h.get("warc-segment-number"))
    if number is not None:
        origin = h.get("warc-segment-origin-id") or h.get("warc-record-id")
        return (*row, None, None, None, block, origin, number, _number(h.get("warc-segment-total-length")), http)
    if kind == "revisit":
        return (*row, None, None, None, None, None, None, None, http)
    size, digest, payload, error = _decoded(iter([block]), http, keep)
    if not error and row[4] not in (None, digest):
        error = "payload digest differs"
    return (*row, size, digest, error, payload, None, None, None, http)


def _broken(record: str | None, error: str) -> tuple:
    row = [None] * len(_PARSED)
    row[_PLACE["record_id"]], row[_PLACE["error"]] = record, error
    return tuple(row)


def _records(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[tuple]:
    """Rows of _PARSED from what stands between version lines, in the order of each split."""
    begun, place = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            here, data = (batch.column("file")[k].as_py(), batch.column("split")[k].as_py()), batch.column("value")[k].as_py()
            if begun is not None:
                if here == place:
                    data = begun + VERSION + CRLF + data
                else:
                    yield _broken(None, "record shorter than its Content-Length")
            begun, place = None, here
            if not data.strip(CRLF):
                continue
            head, border, block = data.partition(CRLF + CRLF)
            size = _number(_headers(head).get("content-length"))
            if not border or size is None or size < 0:
                yield _broken(None, "unreadable record header")
            elif len(block) < size:
                begun = data
            elif block[size:].strip(CRLF):
                yield _broken(_headers(head).get("warc-record-id"), "record longer than its Content-Length")
            else:
                yield _parsed(head, block[:size], keep)
    if begun is not None:
        yield _broken(None, "record shorter than its Content-Length")


def _assembled(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[tuple]:
    """One row of _PARSED for each first segment, from segments sorted by origin and number; of the segments one is
    in memory at a time."""

    def segments() -> Iterator[dict]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield {name: batch.column(name)[k].as_py() for name in _PARSED.names}

    for origin, group in itertools.groupby(segments(), key=lambda s: s["origin"]):
        heads, problems, seen = [], [], {"number": 0, "bytes": 0, "total": None}
        first = next(group)

        def blocks() -> Iterator[bytes]:
            for s in itertools.chain([first], group):
                if s["number"] == 1:
                    heads.append(tuple(s[c] for c in _PARSED.names[:6]))
                if s["number"] == seen["number"]:
                    continue  # the same segment of a repeated page
                if s["number"] != seen["number"] + 1:
                    problems.append(f"segment {seen['number'] + 1} missing")
                    return
                seen.update(number=s["number"], bytes=seen["bytes"] + len(s["payload"]), total=s["total"] if s["total"] is not None else seen["total"])
                yield s["payload"]

        size, digest, payload, error = _decoded(blocks(), first["http"], keep)
        for _ in group:
            pass
        if problems:
            error = problems[0]
        elif seen["total"] != seen["bytes"]:
            error = f"segments of {seen['bytes']} bytes, not {seen['total']}"
        if not heads:
            yield _broken(origin, error)
        for head in heads:
            differs = "payload digest differs" if head[4] not in (None, digest) else None
            yield (*head, size, digest, error or differs, payload, None, None, None, None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives in ``path``, one row each: page_id (of a header that ``write_archives`` adds),
    record_id, record_type, target_uri, payload_digest (as the header says, bare), refers_to_id, payload_bytes,
    found_digest (of the payload found), error, and payload, null without ``with_payload``.

    Segments are one row, that of the first; a payload is the block without HTTP head and chunked framing.
    Records that can't be read have a row with an error: a header without length, a block that ends before
    its Content-Length, also where it holds a version line at the end of a split; a missing segment, another
    total length, bad framing, another digest. Other segments' rows and other records aren't touched by that.
    """
    lines = spark.read.option("lineSep", (VERSION + CRLF).decode()).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    schema = "page_id long, record_id string, record_type string, target_uri string, payload_digest string, refers_to_id string, payload_bytes long, found_digest string, error string, payload binary, origin string, number int, total long, http boolean"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_records(batches, with_payload), _PARSED, _PLACE["payload"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_assembled(batches, with_payload), _PARSED, _PLACE["payload"])

    parsed = written(lines.mapInArrow(parse, schema), "records")
    segments = parsed.where("origin is not null").repartition("origin").sortWithinPartitions("origin", "number")
    return parsed.where("origin is null").unionByName(segments.mapInArrow(assemble, schema)).select(*_READ)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with refers_to, the page_id of the record that a revisit refers to, and that record's
    payload_bytes and found_digest. A revisit of a record that isn't there gets an error."""
    records = written(records, "read_records")
    known = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("bytes"), F.max("found_digest").alias("digest")
    )
    revisits = attached(records.where("record_type = 'revisit'"), known, ["refers_to_id"])
    problem = F.when(F.col("digest").isNull(), "refers to no record").when(F.col("digest") != F.col("payload_digest"), "payload digest differs")
    revisits = revisits.withColumn("error", F.coalesce("error", problem)).withColumn("payload_bytes", F.col("bytes")).withColumn("found_digest", F.col("digest"))
    others = records.where("record_type <> 'revisit' or record_type is null").withColumn("refers_to", F.lit(None).cast("long"))
    return others.unionByName(revisits.select(*others.columns))


def round_trip(pages: DataFrame, segment_bytes: int, chunk_bytes: int) -> DataFrame:
    """Write archives of the pages and read them back: page_id, payload_bytes, payload_digest, record_type,
    refers_to. A record that reads with an error fails the query."""
    spark = pages.sparkSession
    path = shared_folder(spark, "archives")
    write_archives(pages, path, segment_bytes=segment_bytes, chunk_bytes=chunk_bytes)
    drop_at_end(spark, path)
    found = resolved(read_archives(spark, path, with_payload=False))
    digest = F.when(F.col("error").isNull(), F.col("found_digest")).otherwise(F.raise_error(F.concat(F.lit("archive: "), "error")))
    return found.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
