"""Legacy archives to WARC: ARC parsing, conversion with identical-payload revisits, reading back.

ARC files come in two versions whose header lines carry different fields; the version block at the
start of a file names them.  Every document has a declared length.  The converter gives each one a
WARC record identifier, timestamp, type and digests.  WARC files are written by Spark's text
writer with the record end ``CRLF CRLF`` as separator, and read back as binary files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bound_batches, byte_list, materialize, scratch_path, slices

#: The field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS_PER_FILE = 2048
BROADCAST_GROUPS = 100_000  # so many (digest, page_id) rows at most are broadcast, about 10 MB
RECORDS = ("record_id string, page_id long, date string, uri string, ip string, head binary, payload binary, "
           "payload_digest string, payload_bytes long")


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_uuid(page_id: int) -> str:
    """A version-8 (custom) UUID that carries the 64 bits of ``page_id``."""
    n = page_id & (1 << 64) - 1
    return str(uuid.UUID(int=(n >> 62) << 64 | 8 << 76 | 2 << 62 | n & (1 << 62) - 1))


def uuid_page(text: str) -> int | None:
    """The page_id of :func:`page_uuid`, None for any other UUID."""
    x = uuid.UUID(text)
    if x.version != 8:
        return None
    n = (x.int >> 64 & 3) << 62 | x.int & (1 << 62) - 1
    return n - (1 << 64) if n >> 63 else n


# ---------------------------------------------------------------- ARC


def arc_file(name: str, version: int, pages: list[tuple[int | None, str | None, bytes]]) -> bytes:
    """An ARC file of the given version with one HTTP response per (page_id, url, body)."""
    date = "20000101000000"
    intro = f"{version} 0 quarry\n{ARC_FIELDS[version]}\n".encode()
    extra = " 200 - - 0 " + name if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(intro)}\n".encode(), intro]
    offset = sum(map(len, out))
    for page_id, url, body in pages:
        mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(body)}\r\n"
                 f"{mark}\r\n").encode() + body
        uri = "-" if not url else quote(url, safe=":/?#[]@!$&'()*+,;=%~")
        extra = f" 200 {digest(block)} - {offset} {name}" if version == 2 else ""
        line = f"\n{uri} 0.0.0.0 {date} text/html{extra} {len(block)}\n".encode()
        out += [line, block]
        offset += len(line) + len(block)
    out.append(b"\n")
    return b"".join(out)


def read_arc(content: bytes):
    """(fields by name, block) of every document of an ARC file, plain or gzipped.

    The definition line in the version block says which fields a header line has.  Raises
    ValueError where a line or a declared length does not fit.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" \
        else io.BytesIO(content)
    first = stream.readline().split()
    if len(first) < 5 or not first[0].startswith(b"filedesc://"):
        raise ValueError("no ARC version block")
    intro = stream.read(int(first[-1])).splitlines()
    if len(intro) < 2 or intro[0].split()[0] not in (b"1", b"2"):
        raise ValueError("unknown ARC version")
    names = [n.decode() for n in intro[1].split()]
    while line := stream.readline():
        if not line.strip():
            continue
        values = line.rstrip(b"\r\n").split(b" ")
        if len(values) != len(names):
            raise ValueError(f"ARC header line with {len(values)} of {len(names)} fields")
        fields = {n: v.decode("utf-8", "replace") for n, v in zip(names, values)}
        block = stream.read(int(fields["Archive-length"]))
        if len(block) != int(fields["Archive-length"]):
            raise ValueError("ARC document shorter than declared")
        yield fields, block


def _split_http(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(head with its blank line, body, header fields by lower-case name)."""
    at = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or at < 0:
        return b"", block, {}
    head = block[:at + 4]
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:] if line)
    return head, block[at + 4:], {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _pages_to_arc(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            rows = list(zip(part.column("page_id").to_pylist(), part.column("url").to_pylist(),
                            byte_list(part.column("html"))))
            files = []
            for version in (1, 2):
                own = [r for r in rows if (r[0] or 0) % 2 == version - 1]
                if own:
                    name = f"pages-{own[0][0]}-v{version}.arc"
                    files.append((name, arc_file(name, version, own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.binary())],
                names=["path", "content"])


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """ARC files (path, content) of about 512 kB that hold the pages; both versions occur."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_pages_to_arc, "path string, content binary")


def _convert(batches, digests_only: bool):
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for fields, block in read_arc(content.as_py()):
                head, payload, http = _split_http(block)
                mark = http.get("x-page-id", "")
                page_id = int(mark) if mark.lstrip("-").isdigit() else None
                sha1 = digest(payload)
                if digests_only:
                    rows.append((page_id, sha1, len(payload)))
                    continue
                d = fields["Archive-date"]
                name = page_uuid(page_id) if page_id is not None else str(uuid.uuid5(
                    uuid.NAMESPACE_URL, f"{fields['URL']} {d} {digest(block)}"))
                rows.append((f"<urn:uuid:{name}>", page_id,
                             f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
                             None if fields["URL"] == "-" else fields["URL"], fields["IP-address"],
                             head, payload, sha1, len(payload)))
                size += len(block)
                if size > 1 << 22:
                    yield _records(rows)
                    rows, size = [], 0
            if digests_only:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                     pa.array([r[2] for r in rows], pa.int64())], names=["page_id", "payload_digest", "payload_bytes"])
            elif rows:
                yield _records(rows)


_TYPES = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(),
          pa.int64())


def _records(rows) -> pa.RecordBatch:
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)


def convert_arc(archives: DataFrame) -> DataFrame:
    """One row per document of ``archives(content)``: identifiers, timestamp, digests and parts.

    ``record_id`` carries the page_id of an ``X-Page-Id`` header; without one it is derived from
    URL, date and block.  A block without HTTP head is all payload.  A malformed archive raises.
    """
    return archives.select("content").mapInArrow(partial(_convert, digests_only=False), RECORDS)


# ---------------------------------------------------------------- revisits


def repeated_payloads(archives: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(payload_digest, response) of the payloads of at least ``min_bytes`` that occur repeatedly."""
    found = archives.select("content").mapInArrow(
        partial(_convert, digests_only=True), "page_id long, payload_digest string, payload_bytes long")
    return (found.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
            .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).filter("n > 1").drop("n"))


def with_revisits(records: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds ``response``: the page_id a record revisits, null if it is a response itself."""
    repeated = materialize(repeated, "payloads")
    if repeated.count() <= BROADCAST_GROUPS:
        repeated = F.broadcast(repeated)
    joined = records.join(repeated, "payload_digest", "left")
    return joined.withColumn("response", F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")))


# ---------------------------------------------------------------- WARC


def _warc(batches):
    for batch in batches:
        for part in slices(batch, "payload", 1 << 22):
            out = []
            for r in part.to_pylist():
                head, payload = r["head"] or b"", r["payload"] or b""
                again = r["response"] is not None
                block = head if again else head + payload
                lines = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}",
                         f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}"]
                if r["uri"] is not None:
                    lines.append(f"WARC-Target-URI: {r['uri']}")
                lines += [f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
                          f"WARC-Block-Digest: sha1:{digest(block)}"]
                if again:
                    lines += [f"WARC-Profile: {REVISIT_PROFILE}",
                              f"WARC-Refers-To: <urn:uuid:{page_uuid(r['response'])}>"]
                lines += ["Content-Type: application/http; msgtype=response" if head
                          else "Content-Type: application/octet-stream", f"Content-Length: {len(block)}", "", ""]
                out.append("\r\n".join(lines).encode() + block)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write records (with ``response``) as gzipped WARC files of at most RECORDS_PER_FILE records."""
    lines = records.mapInArrow(_warc, "record binary").select(F.col("record").cast("string").alias("value"))
    (lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def read_warc_stream(stream):
    """(header fields by lower-case name, block) of every record of a binary stream."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("WARC record shorter than declared")
        yield fields, block


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"


def _urn(text: str | None) -> int | None:
    return uuid_page(text[len("<urn:uuid:"):-1]) if text else None


def _read(batches):
    for batch in batches:
        for content in batch.column("content"):
            stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 20)
            rows = []
            for fields, block in read_warc_stream(stream):
                head, payload, http = _split_http(block)
                again = fields["warc-type"] == "revisit"
                size = int(http.get("content-length", 0)) if again else len(payload)
                sha1 = fields["warc-payload-digest"].partition(":")[2]
                if not again and digest(payload) != sha1:
                    raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
                rows.append((_urn(fields["warc-record-id"]), size, sha1, fields["warc-type"],
                             _urn(fields.get("warc-refers-to")), fields.get("warc-target-uri")))
            if rows:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=[x.split()[0] for x in READ.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record below ``path``; a response's digest is checked against its payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_read, READ)


def convert(archives: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Convert ``archives(content)`` to WARC files below ``path`` and read them back.

    One row per document: page_id, payload_bytes, payload_digest, record_type, refers_to, uri.  Of
    equal payloads of at least ``min_bytes`` the one with the largest page_id is the response,
    rows that repeat that page_id with the same payload are responses too, and the others revisit
    it without carrying the payload.  Records without page_id never become the response.  Memory
    is bounded by the longest document.
    """
    bound_batches(archives.sparkSession)
    records = with_revisits(convert_arc(archives), repeated_payloads(archives, min_bytes))
    write_warc(records, path)
    return read_warc(archives.sparkSession, path)


def pages_to_warc(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """:func:`convert` on ARC files made from ``pages(page_id, url, html)``; null html is empty."""
    return convert(pages_to_arc(pages), path or scratch_path(pages.sparkSession, "warc"), min_bytes)
