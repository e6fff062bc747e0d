"""WARC records in ZIP packages: writing, and range reads through the ZIP directories."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import materialize, table
from hirewave.session import scratch_path, ship_package

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
RANGE_BYTES = 2 << 20
PIECE_BYTES = 1 << 20
ARCHIVE_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.jsonl"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# records

def _header_value(s: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in s or "")


def warc_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
                refers_to: int | None) -> bytes:
    """One record; a revisit (``refers_to`` given) has no payload, only its HTTP head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    name = "" if page_id is None else str(page_id)
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Target-URI", _header_value(url)),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    f = _fields(head)
    block = rest[:int(f["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, revisit = int(_fields(http)["content-length"]), f["warc-type"] == "revisit"
    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {f['warc-record-id']} does not match its digest")
    page = lambda s: int(s[10:-1]) if s and s != "<urn:page:>" else None
    return {"page_id": page(f["warc-record-id"]), "url": f["warc-target-uri"], "record_type": f["warc-type"],
            "payload_bytes": size, "payload_digest": digest, "refers_to": page(f.get("warc-refers-to")),
            "payload": None if revisit else payload}


# ZIP directories

def zip_members(read, size: int, wanted: Callable[[str], bool] = lambda name: True) -> dict[str, tuple[int, int]]:
    """name -> (offset, length) of the ``wanted`` stored members; ``read(at, n)`` is a range read.

    Reads the end record, the ZIP64 end record where there is one, the central
    directory with its ZIP64 fields, and each wanted member's local header.  A
    wanted member that is compressed by ZIP itself can't be range-read and raises.
    """
    at = max(0, size - 66_000)
    tail = read(at, size - at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack("<10xHII", tail[end:end + 20])
    if end >= 20 and tail[end - 20:end - 16] == b"PK\x06\x07":
        spot = struct.unpack("<Q", tail[end - 12:end - 4])[0]
        wide = read(spot, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        n, length, start = struct.unpack("<32xQQQ", wide)
    directory, found, i = read(start, length), {}, 0
    for _ in range(n):
        sig, method, packed, plain, n_name, n_extra, n_note, local = struct.unpack(
            "<4s6xH8xIIHHH8xI", directory[i:i + 46])
        if sig != b"PK\x01\x02":
            raise ValueError("broken central directory")
        name = directory[i + 46:i + 46 + n_name].decode()
        extra = directory[i + 46 + n_name:i + 46 + n_name + n_extra]
        i += 46 + n_name + n_extra + n_note
        j = 0
        while j + 4 <= len(extra):
            tag, m = struct.unpack("<HH", extra[j:j + 4])
            if tag == 1:  # ZIP64: only the fields that are full in the plain entry, in this order
                wide = list(struct.unpack(f"<{m // 8}Q", extra[j + 4:j + 4 + m // 8 * 8]))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            j += 4 + m
        if name.endswith("/") or not wanted(name):
            continue
        if method:
            raise ValueError(f"{name} is compressed, not stored")
        sig, a, b = struct.unpack("<4s22xHH", read(local, 30))
        if sig != b"PK\x03\x04":
            raise ValueError("broken local header")
        found[name] = (local + 30 + a + b, packed)
    return found


# records of a member

def split_records(raw: bytes) -> Iterator[bytes]:
    """The records of plain WARC text."""
    at = 0
    while at < len(raw):
        head = raw.find(b"\r\n\r\n", at)
        if head < 0 or raw[at:at + 5] != b"WARC/":
            raise ValueError("not a WARC record")
        end = head + 4 + int(_fields(raw[at:head])["content-length"])
        yield raw[at:end]
        at = end + 4 if raw[end:end + 4] == b"\r\n\r\n" else end


def scan_records(read, length: int, piece: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members or plain records of a member, read in pieces."""
    if read(0, min(2, length)) == b"\x1f\x8b":
        at, start, gz, rest = 0, 0, zlib.decompressobj(31), b""
        while start < length:
            if not rest and at < length:
                rest = read(at, min(piece, length - at))
                at += len(rest)
            out = gz.decompress(rest, piece)
            if gz.eof:
                end = at - len(gz.unused_data)
                yield start, end - start
                start, rest, gz = end, gz.unused_data, zlib.decompressobj(31)
            elif not out and not gz.unconsumed_tail and at >= length:
                raise ValueError("a gzip record ends early")
            else:
                rest = gz.unconsumed_tail
        return
    at = 0
    while at < length:
        raw = b""
        while (head := raw.find(b"\r\n\r\n")) < 0:
            more = read(at + len(raw), min(4096, length - at - len(raw)))
            if not more or not (raw + more).startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            raw += more
        end = at + head + 4 + int(_fields(raw[:head])["content-length"])
        if end > length:
            raise ValueError("a record ends early")
        end += 4 * (read(end, min(4, length - end)) == b"\r\n\r\n")
        yield at, end - at
        at = end


def index_spans(raw: bytes) -> list[tuple[str | None, int, int]]:
    """(file name, offset, length) of the lines of an index: JSON, alone or after CDXJ keys, perhaps gzipped.

    An index that is something else gives nothing.
    """
    try:
        raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
        found = [json.loads(line[line.index(b"{"):]) for line in raw.splitlines() if line.strip() and not line.startswith(b"!")]
        return [(x.get("filename"), int(x["offset"]), int(x["length"])) for x in found]
    except (ValueError, KeyError, TypeError, EOFError, OSError, zlib.error):
        return []


def spans_of(member: str, archives: int, length: int, lines: list[tuple[str | None, int, int]]) -> list[tuple[int, int]] | None:
    """Places of a member's records by the index lines that name it, or None where these don't cover it.

    Lines without a file name belong to the only archive of a package.
    """
    names = (None,) * (archives == 1) + (member, member.rpartition("/")[2])
    spans, at = sorted({(o, n) for name, o, n in lines if name in names}), 0
    for o, n in spans:
        if o != at or n <= 0:
            return None
        at += n
    return spans if at == length else None


# jobs

def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(id, url, html, payload_bytes, payload_digest, refers_to); revisits have a null html.

    Equal payloads (length and SHA-1) of at least ``min_bytes`` bytes have one
    response, the row with the largest id (all rows that repeat this id);
    the others refer to it.  Rows with a null id are responses.
    """
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumns(
        {"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1(F.col("html").cast("binary"))})
    last = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_bytes", "payload_digest").agg(
        F.max("id").alias("last")).where("last is not null")
    refers = F.when(F.col("id") < F.col("last"), F.col("last"))
    return rows.join(last, ["payload_bytes", "payload_digest"], "left").withColumn("refers_to", refers).select(
        "id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"),
        "payload_bytes", "payload_digest", "refers_to")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records (from ``with_revisits``) as ZIP packages; (path, bytes, records) of each.

    A package holds gzip-compressed records one after the other, and an index
    of their places, both stored.  A task writes one package for every
    ``ARCHIVE_BYTES``, under a name of its own, so a task that runs again
    never touches another attempt's file; only packages in the returned
    (written-down) list count.
    """
    ship_package(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        fs.create_dir(root, recursive=True)
        body, index = io.BytesIO(), []

        def close() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as z:
                z.writestr(ARCHIVE_MEMBER, body.getbuffer())
                z.writestr(INDEX_MEMBER, "".join(json.dumps(x) + "\n" for x in index))
            with fs.open_output_stream(f"{root}/{path.rpartition('/')[2]}") as out:
                out.write(packed.getbuffer())
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([packed.tell()], pa.int64()), pa.array([len(index)], pa.int64())],
                names=["path", "bytes", "records"])

        for b in batches:
            for page, url, html, size, digest, refers in zip(*(b.column(i) for i in range(6))):
                raw = warc_record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), size.as_py(),
                                  digest.as_py(), refers.as_py())
                member = gzip.compress(raw, 3, mtime=0)
                index.append({"offset": body.tell(), "length": len(member)})
                body.write(member)
                if body.tell() >= ARCHIVE_BYTES:
                    yield close()
                    body, index = io.BytesIO(), []
        if index:
            yield close()

    return materialize(records.select("id", "url", "html", "payload_bytes", "payload_digest", "refers_to").mapInArrow(
        run, "path string, bytes long, records long"), "warc-manifest")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the packages in ``archives`` (path), read in ranges without extraction.

    The directories and indexes are read first; the ranges (neighbouring
    records of up to ``range_bytes``) are dealt out anew and read by as many
    tasks.  Members under archive/ hold gzipped or plain records; one that no
    index covers from end to end is scanned in pieces for its records first.
    Other members are not read, so they may be compressed.  Null paths are
    skipped.
    """
    spark = archives.sparkSession
    ship_package(spark)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                if path is None:
                    continue
                fs, name = _fs(path)
                with fs.open_input_file(name) as f:
                    get = lambda at, n, f=f: f.read_at(n, at)
                    members = zip_members(get, f.size(), lambda m: m.startswith("archive/"))
                    try:
                        index = zip_members(get, f.size(), lambda m: m.startswith("indexes/"))
                    except ValueError:  # compressed: members are scanned
                        index = {}
                    lines = [x for at, n in index.values() for x in index_spans(get(at, n))]
                    ranges = []
                    for m, (start, length) in members.items():
                        spans = spans_of(m, len(members), length, lines)
                        if spans is None:
                            spans = scan_records(lambda at, n, start=start: get(start + at, n), length)
                        fresh = True  # a range holds records of one member
                        for o, n in spans:
                            if not fresh and ranges[-1][1] < range_bytes:
                                ranges[-1] = (ranges[-1][0], ranges[-1][1] + n)
                            else:
                                ranges.append((start + o, n))
                            fresh = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(ranges), pa.string()), pa.array([r[0] for r in ranges], pa.int64()),
                     pa.array([r[1] for r in ranges], pa.int64())], names=["path", "start", "length"])

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, length in zip(*(c.to_pylist() for c in b.columns)):
                fs, name = _fs(path)
                with fs.open_input_file(name) as f:
                    data = f.read_at(length, start)
                rows = []
                if data[:2] != b"\x1f\x8b":
                    rows, data = [parse_record(x) for x in split_records(data)], b""
                while data:
                    gz = zlib.decompressobj(31)
                    rows += [parse_record(x) for x in split_records(gz.decompress(data) + gz.flush())]
                    data = gz.unused_data
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ranges = archives.select("path").mapInArrow(locate, "path string, start long, length long")
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return dealt.mapInArrow(read, "page_id long, url string, record_type string, payload_bytes long, "
                                  "payload_digest string, refers_to long, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = with_revisits(table(spark, sf_dir, "pages"))
    archives = write_archives(records, scratch_path(spark, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES}
                     THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) ELSE page_id END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to FROM m
"""
