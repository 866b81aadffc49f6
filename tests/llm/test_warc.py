"""WARC: round trip, revisits, and salvage of damaged archives."""

import io
import zlib

import pytest

from sluice.llm import warc
from sluice.llm.common import open_folder, shared_folder

PAGES = "page_id bigint, url string, html string, record_type string"
ROWS = [(5, "http://a/x", "<p>same</p>", ""), (2, "http://b/", "<p>same</p>", ""), (9, None, "<p>same</p>", ""),
        (1, "http://c/\r\nWARC-Type: x", "größe " * 5, ""), (3, "u", None, ""), (4, "u", "", ""), (7, "v", "x" * 300000, ""),
        (7, "v", "x" * 300000, ""), (None, "n", "<p>same</p>", ""), (None, "n", "alone", ""),
        (11, "w", "WARC/1.1\r\n\r\n\r\n body", "")]


def expected(rows, least=0):
    first = {}
    for page_id, _, html, _ in rows:
        html = html or ""
        if page_id is not None and len(html.encode()) >= least:
            first[html] = min(first.get(html, page_id), page_id)
    out = []
    for page_id, _, html, _ in rows:
        data, own = (html or "").encode(), first.get(html or "")
        revisit = own is not None and own != page_id
        out.append((page_id, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", own if revisit else None))
    return sorted(out, key=str)


def digest(df):
    return sorted((tuple(r) for r in df.where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, PAGES)
    assert digest(warc.archive_and_read(pages, min_revisit_bytes=least)) == expected(ROWS, least)
    assert digest(warc.archive_and_read(pages.limit(0))) == []


def test_plain_archives_small_files_and_payloads(spark):
    folder = shared_folder(spark, "test-warc")
    manifest = warc.write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1), folder, compress=False, archive_bytes=500)
    paths = [r.path for r in manifest.collect()]
    assert len(paths) > 2 and sum(r.records for r in manifest.collect()) == len(ROWS)
    read = warc.read_archives(spark, paths)
    assert digest(read) == expected(ROWS)
    payloads = {r.page_id: bytes(r.payload) for r in read.where("payload is not null").collect()}
    assert payloads[1] == ("größe " * 5).encode() and payloads[11] == b"WARC/1.1\r\n\r\n\r\n body"
    assert {r.url for r in read.where("page_id = 1").collect()} == {"http://c/%0D%0AWARC-Type: x"}


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


def members(packed):
    records = [warc.record("response", i, f"http://x/{i}", b"<p>%d</p>" % i * 50, warc.base32_sha1(b"<p>%d</p>" % i * 50),
                           None, "2024-01-01T00:00:00Z") for i in range(6)]
    if not packed:
        return records
    out = []
    for r in records:
        squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
        out.append(squeeze.compress(r) + squeeze.flush())
    return out


def read(data, path):
    rows = list(warc.salvage(File(data), path))
    return [r[6] for r in rows if r[0] == "record"], [(r[2], r[3]) for r in rows if r[0] == "gap"]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts, path = members(packed), "a.warc.gz" if packed else "a.warc"
    ends = [sum(map(len, parts[:i])) for i in range(7)]
    assert read(b"".join(parts), path) == ([0, 1, 2, 3, 4, 5], [])
    # Damage inside the third record, also right at its start: the records after it come back, the gap is logged.
    for place in (0, 1, 20, len(parts[2]) // 2, len(parts[2]) - 5):
        hurt = bytearray(parts[2])
        hurt[place] ^= 0x55
        assert read(b"".join([*parts[:2], bytes(hurt), *parts[3:]]), path) == ([0, 1, 3, 4, 5], [(ends[2], ends[3])])
    # Strange bytes between records, at the start and at the end; two neighbouring bad records are one gap.
    junk = b"\x1f\x8b\x08junk WARC/9 " * 3
    assert read(parts[0] + junk + parts[1], path) == ([0, 1], [(ends[1], ends[1] + len(junk))])
    assert read(junk + parts[0], path) == ([0], [(0, len(junk))])
    cut = b"".join(parts[:3])[:-7]
    assert read(cut, path) == ([0, 1], [(ends[2], len(cut))])
    bad = b"".join([parts[0], parts[1][:30], parts[2][:30], parts[3]])
    assert read(bad, path) == ([0, 3], [(ends[1], ends[1] + 60)])
    assert read(b"", path) == ([], [])
    assert read(b"nothing here", path) == ([], [(0, 12)])


def test_gaps_are_rows(spark):
    folder = shared_folder(spark, "test-warc")
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    parts = members(True)
    with store.open_output_stream(f"{root}/x.warc.gz", compression=None) as f:
        f.write(parts[0] + b"??" + parts[1])
    rows = warc.read_archives(spark, [f"{folder}/x.warc.gz"]).collect()
    assert [(r.kind, r.from_byte, r.to_byte) for r in rows] == [
        ("record", 0, len(parts[0])), ("gap", len(parts[0]), len(parts[0]) + 2),
        ("record", len(parts[0]) + 2, len(parts[0]) + 2 + len(parts[1]))]
    assert rows[1].problem


def foreign(kind, block, *lines):
    head = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", "WARC-Target-URI: http://f/", *lines, f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


BODY = b"line one\r\n\r\nline two"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"


def sha(name, data, form="hex"):
    import base64
    import hashlib
    found = hashlib.new(name, data).digest()
    return f"{name}:" + (found.hex() if form == "hex" else base64.b32encode(found).decode())


@pytest.mark.parametrize("record, want", [
    (foreign("resource", BODY, "Content-Type: text/plain", "WARC-Payload-Digest: " + sha("sha1", BODY, "b32")), BODY),
    (foreign("resource", BODY, "Content-Type: text/plain"), BODY),
    (foreign("metadata", b"", "Content-Type: application/warc-fields"), b""),
    (foreign("conversion", BODY), BODY),
    (foreign("response", HTTP, "Content-Type: application/http; msgtype=response", "WARC-Block-Digest: " + sha("sha256", HTTP)), b"hello"),
    (foreign("response", HTTP, "Content-Type: APPLICATION/HTTP", "WARC-Block-Digest: " + sha("md5", HTTP, "b32"),
             "WARC-Payload-Digest: sha1:OFSOMETHINGELSE"), b"hello"),
    (foreign("response", HTTP, "WARC-Block-Digest: blake9:zzzz", "WARC-Payload-Digest: " + sha("sha1", b"hello")), b"hello"),
    (foreign("response", HTTP), b"hello"),
    (foreign("revisit", b"", "Content-Type: application/http", "WARC-Payload-Digest: " + sha("sha1", b"x", "b32")), None),
    (foreign("revisit", HTTP[:-5], "Content-Type: application/http"), None)])
@pytest.mark.parametrize("packed", [True, False])
def test_valid_foreign_records_are_read(record, want, packed):
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    data = squeeze.compress(record) + squeeze.flush() if packed else record
    rows = list(warc.salvage(File(data), "f.warc.gz" if packed else "f.warc"))
    assert [(r[0], r[11]) for r in rows] == [("record", want)]
    if want is not None:
        assert rows[0][8:10] == (len(want), warc.base32_sha1(want))
    else:
        assert rows[0][8] == (5 if HTTP[:-5] in record else None)


@pytest.mark.parametrize("record", [
    foreign("resource", BODY, "Content-Type: text/plain", "WARC-Payload-Digest: " + sha("sha1", b"other", "b32")),
    foreign("resource", BODY, "WARC-Block-Digest: " + sha("sha512", b"other")),
    foreign("response", HTTP, "WARC-Payload-Digest: " + sha("sha256", b"other")),
    foreign("strange", BODY), foreign("resource", BODY).replace(b"Content-Length: 20", b"Content-Length: 19"),
    foreign("resource", BODY).replace(b"Content-Length", b"Content-Size")])
def test_damage_is_quarantined(record):
    sound = foreign("resource", BODY)
    for path in ("f.warc", "f.warc.gz"):
        parts = [sound, record, sound]
        if path.endswith("gz"):
            parts = [(lambda s, r: s.compress(r) + s.flush())(zlib.compressobj(3, zlib.DEFLATED, 31), r) for r in parts]
        rows = list(warc.salvage(File(b"".join(parts)), path))
        assert [r[0] for r in rows] == ["record", "gap", "record"]
        assert (rows[1][2], rows[1][3]) == (len(parts[0]), len(parts[0]) + len(parts[1]))


def test_members_of_several_records():
    sound, bad = foreign("resource", BODY), foreign("resource", BODY, "WARC-Block-Digest: " + sha("sha1", b"other"))

    def packed(data):
        squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
        return squeeze.compress(data) + squeeze.flush()

    for inside, want in (([sound, sound], ["record"] * 2), ([sound, bad, bad, sound], ["record", "gap", "record"]),
                         ([bad, sound], ["gap", "record"]), ([sound, b"cut WARC/1.0"], ["record", "gap"])):
        member = packed(b"".join(inside))
        rows = list(warc.salvage(File(member + packed(sound)), "m.warc.gz"))
        assert [r[0] for r in rows] == [*want, "record"]
        assert {(r[2], r[3]) for r in rows[:-1]} == {(0, len(member))}
