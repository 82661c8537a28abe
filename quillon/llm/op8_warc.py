"""WARC archives: a writer, and a salvage reader.

Writing: each page becomes one record whose payload is its html in UTF-8, in a gzip
member of its own. Of the records with equal payloads of ``MIN_REVISIT`` bytes or more, that
with the largest page_id is a response; the others are revisit records, which hold the
HTTP header, the payload digest and a reference to the response, but no payload. Members
are gathered into archives of about ``ARCHIVE_BYTES``, one row each, and Spark's text
writer puts each into a file of its own (bytes as they are, CR LF CR LF as the end of the
row, which readers of WARC files take as padding). So files go wherever Spark can write, and
a task that runs again leaves no second copy.

Reading: files come through Spark's binary reader. The reader checks each member (gzip CRC),
header, length, block digest and payload digest. Where a check fails, it looks for the next
gzip member or version line from which a record can be read, goes on there, and logs the
bytes between as a quarantined gap with the reason. A record whose digest fails, but whose length leads to
a record, a member or the end, is passed by as a whole, so that version lines in its payload are not taken for records;
where the length fails too, a whole record inside the damaged one is taken. Folded header lines and bytes
that are no UTF-8 in a header are read. From a broken member the records that
precede the damage and pass their checks are kept. Members and plain records may be mixed. A task holds a
whole archive: one that Spark's binary reader gives (under 2 GB), the writer's have about ``ARCHIVE_BYTES``.

Defined results: null html is an empty payload. Rows without page_id have records without
one; they can be revisits, and a response only if no equal payload has a page_id. Repeated
rows have a record each; rows with the same page_id and payload are of one type. Control
characters and spaces in urls are percent-encoded, a null url is empty. Empty table: no
rows, no archives. Other columns are not looked at.
"""

from __future__ import annotations

import gzip
import re
import zlib
from hashlib import sha1
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import staged, table
from quillon.session import staging_path

MIN_REVISIT, ARCHIVE_BYTES = 1000, 8_000_000
_VERSION, _MEMBER, _PAD = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n"
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.")
_CONTROL, _TOKEN = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]"), re.compile(r"[!#$%&'*+.^_`|~0-9a-z-]+")
_VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")
_STEP = 1 << 16


def _urn(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record, uncompressed."""
    digest = sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1(block).hexdigest()}",
    ]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + _PAD


class Damaged(Exception):
    """A failed check; ``end`` is the end of the record where its header is sound and its stated length leads to a record, a member or the end."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def _fields(raw: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a folded line goes on with the field before it, bytes that are no UTF-8 are replaced.

    Control bytes and names that are no tokens are errors, and so is a second version line with a type after it: there a
    member or another record begins inside a header that was cut.
    """
    again = _VERSION_LINE.search(raw, 1)
    if _CONTROL.search(raw) or (again and b"\nwarc-type:" in raw[again.start() :].lower()):
        raise ValueError("cut header")
    out: dict[str, str] = {}
    name = ""
    for line in raw.decode(errors="replace").split("\r\n")[1:]:
        if line.startswith((" ", "\t")) and name:
            out[name] = f"{out[name]} {line.strip()}".strip()
        else:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            if not _TOKEN.fullmatch(name):
                raise ValueError("field name")
            out[name] = value.strip()
    return out


def _parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the plain record at ``at``, with its checks."""
    if not data.startswith(_VERSION, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header without end")
    try:
        head = _fields(data[at:end])
        size = int(head["content-length"])
    except (ValueError, KeyError):
        raise Damaged("header") from None
    block = data[end + 4 : end + 4 + size]
    if size < 0 or len(block) < size or not data.startswith(_PAD, end + 4 + size):
        raise Damaged("length")
    stop = end + 8 + size
    known = stop if stop >= len(data) or data.startswith((_VERSION, _MEMBER), stop) else None
    want = head.get("warc-block-digest", "")
    if want.startswith("sha1:") and sha1(block).hexdigest() != want[5:]:
        raise Damaged("block digest", known)
    http, sep, payload = block.partition(b"\r\n\r\n")
    want = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "response" and want.startswith("sha1:") and sha1(payload).hexdigest() != want[5:]:
        raise Damaged("payload digest", known)
    return head, block, stop


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """(content, end, fault) of the gzip member at ``at``; with a fault, what came before it."""
    d, out, pos = zlib.decompressobj(31), [], at
    while not d.eof and pos < len(data):
        before = d.copy()
        try:
            out.append(d.decompress(data[pos : pos + _STEP]))
        except zlib.error as e:
            try:  # what the bytes before the damage give
                for k in range(pos, pos + _STEP, 64):
                    out.append(before.decompress(data[k : k + 64]))
            except zlib.error:
                pass
            return b"".join(out), at, f"gzip: {str(e)[:60]}"
        pos += _STEP
    if not d.eof:
        return b"".join(out), at, "gzip: cut off"
    return b"".join(out), min(pos, len(data)) - len(d.unused_data), ""


def salvage(data: bytes):
    """("record", offset, headers, block) and ("gap", start, end, reason) in the order of the archive.

    The offset is that of the record, or of the member that it stands in.
    """
    view, at, n, gap, why = memoryview(data), 0, len(data), None, ""
    while at < n:
        if data[at] in b"\r\n":
            at += 1
            continue
        found, end, fault, stop = [], at, "", None
        if data.startswith(_MEMBER, at):
            content, end, fault = _inflate(view, at)
            pos = 0
            while pos < len(content):
                try:
                    head, block, pos = _parse(content, pos)
                    found.append((head, block))
                except Damaged as e:
                    if not fault:  # the member is sound, a record in it isn't: go on in the member
                        inner = _NEXT.search(content, pos + 1)
                        yield "gap", at, end, f"in a member: {e}"
                        if e.end is not None or inner:
                            pos = inner.start() if e.end is None else e.end
                            continue
                    break
        else:
            try:
                head, block, end = _parse(data, at)
                found.append((head, block))
            except Damaged as e:
                fault, stop = str(e), e.end
        if gap is not None and (found or not fault):
            yield "gap", gap, at, why
            gap = None
        for head, block in found:
            yield "record", at, head, block
        if fault:
            if gap is None:
                gap, why = at, fault
            following = _NEXT.search(data, at + 1) if stop is None else None
            at = stop if stop is not None else following.start() if following else n
        else:
            at = end
    if gap is not None:
        yield "gap", gap, n, why


def _write_batches(batches):
    held: list[bytes] = []
    size = 0
    for batch in batches:
        urls, htmls = batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
        for page_id, url, html, revisit, refers_to in zip(batch.column(0).to_pylist(), urls, htmls, batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            member = gzip.compress(record(page_id, url, html or b"", refers_to, revisit), 6, mtime=0)
            held.append(member)
            size += len(member)
            if size >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files of gzip members below ``path``."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("mark", F.sha2(F.col("html").cast("binary"), 256))
    marks = staged(p.select("page_id", "mark", F.octet_length("html").alias("bytes")), "warc-marks")
    alike = marks.where(F.col("bytes") >= MIN_REVISIT).groupBy("mark").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1 and last is not null")
    again = marks.join(alike, "mark").where("page_id is null or page_id <> last")
    again = again.groupBy(F.col("page_id").alias("again_id"), F.col("mark").alias("again_mark")).agg(F.max("last").alias("refers_to"))
    both = p.join(again, p["page_id"].eqNullSafe(again["again_id"]) & (p["mark"] == again["again_mark"]), "left")
    rows = both.select("page_id", "url", "html", F.col("refers_to").isNotNull().alias("revisit"), "refers_to")
    archives = rows.mapInArrow(_write_batches, "archive binary")
    # the cast keeps the bytes; the text writer copies them
    archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", _PAD.decode()).option("maxRecordsPerFile", 1).text(path)


_READ = "kind string, archive string, start long, end long, reason string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string"


def _read_batches(batches):
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            for kind, a, b, c in salvage(data):
                if kind == "gap":
                    rows.append(("gap", name, a, b, c, None, None, None, None, None, None))
                    continue
                http, _, payload = c.partition(b"\r\n\r\n")
                kept = b["warc-type"] == "response"
                stated = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                size = len(payload) if kept else int(stated[1]) if stated else None
                digest = sha1(payload).hexdigest() if kept else b.get("warc-payload-digest", "").removeprefix("sha1:") or None
                number = lambda k: int(b[k]) if b.get(k, "").lstrip("-").isdigit() else None  # noqa: B023,E731
                rows.append(("record", name, a, None, None, number("warc-page-id"), b["warc-type"], size, digest, number("warc-refers-to-page-id"), b.get("warc-target-uri")))
            cols = list(zip(*rows)) if rows else [[]] * 11
            types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[c.split()[0] for c in _READ.split(", ")])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps (kind: record or gap) of all archives below ``path``."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content").mapInArrow(_read_batches, _READ)


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path).where("kind = 'record'")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= {MIN_REVISIT} AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT} AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM m
"""
