"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Writing: equal payloads are found by SHA-1 and length in one pre-aggregated
shuffle that carries no payload. The record with the smallest page_id keeps
the payload (``response``), the others refer to it (``revisit``: HTTP headers
and digest, no payload). Each task writes archives of its own, one gzip
member a record; only files named in the committed manifest are read, so a
task that is run again leaves no duplicates.

Reading: a member is checked for its CRC, its records for version line, header,
length, type and digests. A block digest decides; a payload digest does where
no block digest could be checked. Digests may be in base32 or hexadecimal and
of any algorithm of ``ALGORITHMS``; others are not checked. HTTP headers are
taken off the block of HTTP messages only: the payload of any other record
(resource, metadata, conversion ...) is its whole block. A revisit may have an
empty block; the size of its payload is then not known (null). A member may
hold several records. After a failed check the reader searches byte by byte for the
next member (or, in plain files, version line) that starts a record, carries
on there, and logs the skipped bytes as a quarantined gap. Files are read in
windows; memory is bounded by the largest record or member.

Defined cases: null html is an empty payload; a null url has no target URI,
line breaks in a url are percent-encoded; rows that repeat both page_id and
payload are all of the same type; a null page_id is a revisit if a row with
an id has its payload, else a response; empty tables give no archives and no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import arrow_rows, empty_frame, open_folder, shared_folder
from sluice.session import materialize

VERSION = b"WARC/1.1\r\n"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KINDS = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
ALGORITHMS = ("md5", "sha1", "sha256", "sha384", "sha512")  # digests that can be checked
GZIP_MAGIC = b"\x1f\x8b\x08"
# Record ids name the page; pages without an id are named by their digest.
PAGE_URN = "urn:x-page:"

READ = ("kind string, path string, from_byte bigint, to_byte bigint, problem string, record_type string, "
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- writing

def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP headers of the full payload, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{PAGE_URN}{'none:' + digest if page_id is None else page_id}>",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_record_types(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, refers_to): refers_to is set for revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                         F.sha1(payload).alias("sha1"), F.length(payload).alias("size"))
    keys = keyed.select("page_id", "sha1", "size").where(F.col("size") >= min_revisit_bytes)
    # Written, so that the join below reads plain shuffles on both sides, whose hot partitions Spark splits.
    shared = materialize(keys.groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                         .where("n > 1").drop("n"), "warc-shared")
    revisits = (keys.join(shared, ["sha1", "size"]).where("first is not null and not (page_id <=> first)")
                .select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), F.col("first").alias("refers_to"))
                .distinct())
    same = keyed.page_id.eqNullSafe(revisits.r_id) & (keyed.sha1 == revisits.r_sha1)
    return keyed.join(revisits, same, "left").select("page_id", "url", "html", "sha1", "refers_to")


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, compress: bool = True,
                   archive_bytes: int = 512 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row below ``folder``; returns the committed manifest (path, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = open_folder(folder)
        out, name, parts, records, size, made = None, "", 0, 0, 0, []
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    if out is not None and size >= archive_bytes:
                        out.close()
                        made.append((f"{folder}/{name}", records, size))
                        out = None
                    if out is None:
                        store.create_dir(root, recursive=True)
                        name = (f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{parts:04d}.warc"
                                + ".gz" * compress)
                        out, parts, records, size = store.open_output_stream(f"{root}/{name}", compression=None), parts + 1, 0, 0
                    data = record("response" if r["refers_to"] is None else "revisit", r["page_id"], r["url"],
                                  (r["html"] or "").encode(), base64.b32encode(bytes.fromhex(r["sha1"])).decode(),
                                  r["refers_to"], date)
                    if compress:
                        squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
                        data = squeeze.compress(data) + squeeze.flush()
                    out.write(data)
                    records, size = records + 1, size + len(data)
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", records, size))
        yield from arrow_rows(made, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    rows = with_record_types(pages, min_revisit_bytes)
    return materialize(rows.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-manifest")


# ---------------------------------------------------------------- reading

class Damaged(Exception):
    """A check of a record failed."""


class Window:
    """Reads a file of any size through one buffer."""

    def __init__(self, file, size: int = 4 << 20):
        self.file, self.end, self.size = file, file.size(), size
        self.at, self.data = 0, b""

    def read(self, at: int, n: int) -> bytes:
        n = min(n, self.end - at)
        if n <= 0:
            return b""
        if at < self.at or at + n > self.at + len(self.data):
            self.at, self.data = at, self.file.read_at(min(max(n, self.size), self.end - at), at)
        return self.data[at - self.at:at - self.at + n]

    def find(self, what: bytes, at: int) -> int:
        """Position of the next ``what`` from ``at`` on, or the end of the file."""
        while at < self.end:
            part = self.read(at, self.size)
            hit = part.find(what)
            if hit >= 0:
                return at + hit
            at += max(1, len(part) - len(what) + 1)
        return self.end


def _member(window: Window, at: int, limit: int | None = None) -> tuple[bytes, int]:
    """The data of the gzip member at ``at`` (its first ``limit`` bytes at least) and the position after it."""
    expand, out, pos, step, got = zlib.decompressobj(31), [], at, 4096, 0
    try:
        while not expand.eof:
            raw = window.read(pos, step)
            if not raw:
                raise Damaged("the member is cut short")
            out.append(expand.decompress(raw))
            got += len(out[-1])
            pos += len(raw)
            if limit is not None and got >= limit:
                break
            step = min(step * 2, 1 << 20)
    except zlib.error as e:
        raise Damaged(f"the member does not expand: {e}") from None
    return b"".join(out), pos - len(expand.unused_data)


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _page(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _length(head: dict[str, str]) -> int:
    value = head.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise Damaged("no content length")
    return int(value)


def _digests(stated: str, data: bytes) -> bool | None:
    """Whether ``data`` has the stated digest (``algorithm:value``, the value in base32 or hexadecimal); None if that is
    not known: nothing is stated, or an algorithm this reader does not have."""
    name, colon, value = stated.partition(":")
    if not colon or name.lower() not in ALGORITHMS:
        return None
    found = hashlib.new(name.lower(), data).digest()
    return value.lower() == found.hex() or value.upper().rstrip("=") == base64.b32encode(found).decode().rstrip("=")


def extent(data: bytes, at: int = 0) -> tuple[dict[str, str], int, int]:
    """(header, start and end of the block) of the record at ``at``, after the checks of its frame."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("the header does not end")
    head = _headers(data[at + 10:end])
    to = end + 4 + _length(head)
    if len(data) < to or data[to:to + 4] != b"\r\n\r\n":
        raise Damaged("the block has another length")
    return head, end + 4, to


def parse(head: dict[str, str], block: bytes) -> tuple:
    """The fields of one record, after the checks of its type and digests."""
    kind = head.get("warc-type", "")
    if kind not in KINDS:
        raise Damaged("no record type")
    sound = _digests(head.get("warc-block-digest", ""), block)
    if sound is False:
        raise Damaged("the block has another digest")
    # Only an HTTP message has HTTP headers before its payload; the block of any other record is the payload.
    http, payload = b"", block
    if head.get("content-type", "application/http" if block.startswith(b"HTTP/") else "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    stated = head.get("warc-payload-digest", "")
    named = _page(head.get("warc-record-id")), head.get("warc-target-uri")
    if kind == "revisit":
        size = _headers(http).get("content-length", "")
        return kind, *named, int(size) if size.isascii() and size.isdigit() else None, stated.removeprefix("sha1:"), \
            _page(head.get("warc-refers-to")), None
    # A block that was verified is whole, whatever its writer took for the payload (chunks, encodings).
    if sound is None and _digests(stated, payload) is False:
        raise Damaged("the payload has another digest")
    return kind, *named, len(payload), base32_sha1(payload), None, payload


def records_of(data: bytes) -> Iterator[tuple | Damaged]:
    """The records of an expanded member in order, each one's fields or what is wrong; after damage the next version
    line that starts a record is searched for."""
    at, hurt = 0, None
    while at < len(data):
        try:
            head, start, to = extent(data, at)
            fields = parse(head, data[start:to])
        except Damaged as e:
            hurt = hurt or e
            at = data.find(b"WARC/1.", at + 1)
            if at < 0:
                break
            continue
        if hurt is not None:
            yield hurt
            hurt = None
        yield fields
        at = to + 4
    if hurt is not None:
        yield hurt
    elif not data:
        yield Damaged("the member is empty")


def _plain(window: Window, at: int) -> tuple[bytes, int]:
    """The bytes of the uncompressed record at ``at`` and the position after it."""
    end = window.find(b"\r\n\r\n", at)
    if window.read(at, 5) != b"WARC/" or end >= window.end:
        raise Damaged("no record header")
    to = end + 4 + _length(_headers(window.read(at + 10, end - at - 10))) + 4
    if to > window.end:
        raise Damaged("the record is cut short")
    return window.read(at, to - at), to


def _next_start(window: Window, at: int, packed: bool) -> int:
    """The next position from ``at`` on where a member or version line starts a record, or the end."""
    mark = GZIP_MAGIC if packed else b"WARC/1."
    while (at := window.find(mark, at)) < window.end:
        try:
            if not packed or _member(window, at, 7)[0].startswith(b"WARC/1."):
                return at
        except Damaged:
            pass
        at += 1
    return window.end


def salvage(file, path: str) -> Iterator[tuple]:
    """Rows of ``READ`` for one archive: its records and quarantined gaps, in order.

    A damaged record beside sound ones in one gzip member is a gap of the member's bytes.
    """
    window = Window(file)
    packed = path.endswith(".gz") or not path.endswith(".warc") and window.read(0, 3) == GZIP_MAGIC
    at, gap, why = 0, None, ""

    def row_of(start: int, to: int, problem: str) -> tuple:
        return "gap", path, start, to, problem, None, None, None, None, None, None, None

    while at < window.end:
        try:
            if packed:
                data, to = _member(window, at)
                found = list(records_of(data))
                if all(isinstance(f, Damaged) for f in found):
                    raise found[0]
            else:
                data, to = _plain(window, at)
                head, start, end = extent(data)
                found = [parse(head, data[start:end])]
        except Damaged as e:
            if gap is None:
                gap, why = at, str(e)
            at = _next_start(window, at + 1, packed)
            continue
        if gap is not None:
            yield row_of(gap, at, why)
            gap = None
        for f in found:
            yield row_of(at, to, str(f)) if isinstance(f, Damaged) else ("record", path, at, to, None, *f)
        at = to
    if gap is not None:
        yield row_of(gap, window.end, why)


def read_archives(spark: SparkSession, paths: list[str], payloads: bool = True) -> DataFrame:
    """Records (kind ``record``) and quarantined byte gaps (kind ``gap``) of the archives."""
    if not paths:
        return empty_frame(spark, READ)
    schema = pa.schema([("kind", pa.string()), ("path", pa.string()), ("from_byte", pa.int64()), ("to_byte", pa.int64()),
                        ("problem", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = open_folder(path)
                with store.open_input_file(name) as file:
                    rows, size = [], 0
                    for row in salvage(file, path):
                        rows.append(row if payloads else (*row[:-1], None))
                        size += len(rows[-1][-1] or b"") + 200
                        if size > 8 << 20:
                            yield from arrow_rows(rows, schema)
                            rows, size = [], 0
                    yield from arrow_rows(rows, schema)

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths)).mapInArrow(read, READ)


def archive_and_read(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read them back, without the payloads."""
    spark = pages.sparkSession
    manifest = write_archives(pages, folder or shared_folder(spark, "warc"), min_revisit_bytes)
    paths = [r.path for r in manifest.select("path").orderBy("path").collect()]  # one row an archive
    return read_archives(spark, paths, payloads=False)
