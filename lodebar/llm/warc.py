"""WARC records in ZIP-packaged archives, written and read back in place.

An archive is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``, every record a gzip member of
its own, and ``indexes/index.cdxj``, a line for each record with its place. A reader needs the end of the file, the
central directory (ZIP64 where sizes ask for it), the index, and then only the ranges of the records that it wants;
nothing is extracted. Neighbouring ranges are read together.

Of records with equal payloads of at least MIN_REVISIT bytes that with the smallest page_id is a response, the others
are revisits: headers that name it, without the payload. Payloads stay where they are read; only digests that occur
twice or more travel, broadcast up to BROADCAST_DIGESTS of them and joined by a shuffle beyond.

Tasks write files under names of their own and list them in a manifest; what a lost attempt has left is in no manifest.

Defined results: null html is an empty payload; a null url leaves out its header; the record of a null id
carries none and is a revisit if an equal payload has an id; equal payloads that all lack ids are all responses.
Repeated rows with the smallest id are all responses. Other columns are not read. Empty tables give no archives.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.llm.common import frugal, scratch_path, staged

MIN_REVISIT = 100
#: An archive ends when its records take so many bytes; a record is never split.
ARCHIVE_BYTES = 24 << 20
#: Ranges that follow each other are read together up to so many bytes.
READ_BYTES = 4 << 20
BROADCAST_DIGESTS = 500_000

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"

# Fixed values of the ZIP and WARC formats.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


def storage(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that the cluster's storage gives it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


# ---- records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit where ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{'urn:uuid:' + str(uuid.uuid4()) if page_id is None else f'urn:page:{page_id}'}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    lines += ["WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _head(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}, rest


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn.startswith("<urn:page:") else None


def parsed(raw: bytes) -> tuple:
    """A row of RECORDS from a record's bytes; its digest is checked against the payload that is there."""
    head, rest = _head(raw)
    size = int(head["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, payload = _head(rest[:size])
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    revisit = head["warc-type"] == "revisit"
    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ValueError("a payload doesn't have its record's digest")
    return _page(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], _page(head.get("warc-refers-to")), int(http["content-length"]), digest, None if revisit else payload


# ---- ZIP


def zipped(members: list[tuple[str, bytes]], zip64: bool = False) -> Iterator[bytes]:
    """A ZIP file of stored members; with ``zip64`` its 64-bit fields are used even where 32 bits would do."""
    at, central = 0, []
    for name, data in members:
        n, crc = name.encode(), zlib.crc32(data)
        large = zip64 or len(data) >= _MAX32
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if large else b""
        size = _MAX32 if large else len(data)
        local = struct.pack("<IHHHHHIIIHH", _LOCAL, 45 if large else 20, 0x800, 0, 0, 0x21, crc, size, size, len(n), len(extra)) + n + extra
        far = zip64 or at >= _MAX32
        wide = (struct.pack("<QQ", len(data), len(data)) if large else b"") + (struct.pack("<Q", at) if far else b"")
        extra = struct.pack("<HH", 1, len(wide)) + wide if wide else b""
        central.append(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x800, 0, 0, 0x21, crc, size, size, len(n), len(extra), 0, 0, 0, 0, _MAX32 if far else at) + n + extra)
        yield local
        yield data
        at += len(local) + len(data)
    directory = b"".join(central)
    yield directory
    n, large = len(members), zip64 or at >= _MAX32 or len(members) >= _MAX16
    if large:
        yield struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, len(directory), at)
        yield struct.pack("<IIQI", _LOCATOR, 0, at + len(directory), 1)
    yield struct.pack("<IHHHHIIH", _END, 0, 0, _MAX16 if large else n, _MAX16 if large else n, _MAX32 if large else len(directory), _MAX32 if large else at, 0)


@dataclass
class Member:
    name: str
    size: int
    at: int  # where its bytes begin


class ZipArchive:
    """A ZIP file's stored members, found by range reads from its end."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.size = file, file.size()
        tail_at = max(0, self.size - (22 + _MAX16))
        tail = self._read(tail_at, self.size - tail_at)
        end = tail.rfind(struct.pack("<I", _END))
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] > len(tail)):
            end = tail.rfind(struct.pack("<I", _END), 0, end)
        if end < 0:
            raise ValueError("not a ZIP file")
        count, size, at = struct.unpack_from("<HII", tail, end + 10)
        if (count == _MAX16 or size == _MAX32 or at == _MAX32) and end + tail_at >= 20:
            mark, _, end64, _ = struct.unpack("<IIQI", self._read(tail_at + end - 20, 20))
            if mark == _LOCATOR:
                found = struct.unpack("<IQHHIIQQQQ", self._read(end64, 56))
                if found[0] != _END64:
                    raise ValueError("the ZIP64 directory's end is not where its locator says")
                count, size, at = found[7:10]
        self.members = dict(self._members(self._read(at, size), count))

    def _read(self, at: int, size: int) -> bytes:
        got = self.file.read_at(size, at)
        if len(got) != size:
            raise ValueError("the file ends early")
        return got

    def _members(self, directory: bytes, count: int) -> Iterator[tuple[str, Member]]:
        at = 0
        for _ in range(count):
            f = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
            if f[0] != _CENTRAL:
                raise ValueError("the central directory is broken")
            name = directory[at + 46 : at + 46 + f[10]].decode()
            extra = directory[at + 46 + f[10] : at + 46 + f[10] + f[11]]
            packed, size, local = f[8], f[9], f[16]
            while len(extra) >= 4:
                kind, n = struct.unpack_from("<HH", extra)
                if kind == 1:  # 64-bit values of those fields that are full, in this order
                    wide = iter(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                    size = next(wide) if size == _MAX32 else size
                    packed = next(wide) if packed == _MAX32 else packed
                    local = next(wide) if local == _MAX32 else local
                extra = extra[4 + n :]
            if f[4] == 0 and not name.endswith("/"):
                names, extras = struct.unpack("<HH", self._read(local + 26, 4))
                yield name, Member(name, packed, local + 30 + names + extras)
            at += 46 + f[10] + f[11] + f[12]

    def bytes_of(self, name: str) -> bytes:
        return self._read(self.members[name].at, self.members[name].size)

    def ranges(self, name: str, wanted: list[tuple[int, int]]) -> Iterator[bytes]:
        """Bytes of (offset, length) ranges of a member, neighbours read together."""
        at, i = self.members[name].at, 0
        while i < len(wanted):
            first, j, end = wanted[i][0], i, wanted[i][0]
            while j < len(wanted) and wanted[j][0] == end and (j == i or end + wanted[j][1] - first <= READ_BYTES):
                end += wanted[j][1]
                j += 1
            got = memoryview(self._read(at + first, end - first))
            for offset, length in wanted[i:j]:
                yield bytes(got[offset - first : offset - first + length])
            i = j


# ---- Spark


def _digested(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.sha2("payload", 256))


def write_archives(pages: DataFrame, folder: str, zip64: bool = False, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each page (page_id, url, html) under ``folder``; (path, records, bytes) of each archive."""
    rows = _digested(pages)
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT)
    twice = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    twice = staged(twice.select("digest", "first"), "warc-digests")
    if twice.count() <= BROADCAST_DIGESTS:
        twice = F.broadcast(twice)
    where = qualified(pages.sparkSession, folder)
    named = rows.join(twice, "digest", "left").select("page_id", "url", "payload", "digest", F.expr("if(first <=> page_id, null, first)").alias("refers_to"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = storage(where)
        store.create_dir(base, recursive=True)
        data: list[bytes] = []
        index: list[str] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"{base}/{uuid.uuid4().hex}.wacz"
            package = json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}).encode()
            with store.open_output_stream(name) as out:
                for part in zipped([("datapackage.json", package), (DATA, b"".join(data)), (INDEX, "".join(index).encode())], zip64):
                    out.write(part)
                written = out.tell()
            return pa.RecordBatch.from_arrays([pa.array([f"{where}/{name.rpartition('/')[2]}"]), pa.array([len(index)], pa.int64()), pa.array([written], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            ids, urls, payloads, digests, refers = (c.to_pylist() for c in batch.columns)
            for page_id, url, payload, digest, refers_to in zip(ids, urls, payloads, digests, refers, strict=True):
                packer = zlib.compressobj(1, wbits=31)
                raw = packer.compress(record(page_id, url, payload, digest, refers_to)) + packer.flush()
                index.append(json.dumps({"page": page_id, "offset": size, "length": len(raw)}) + "\n")
                data.append(raw)
                size += len(raw)
                if size >= archive_bytes:
                    yield close()
                    data, index, size = [], [], 0
        if data:
            yield close()

    return staged(named.mapInArrow(lambda b: frugal(work(b)), "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of all archives that ``manifest`` (path, ...) lists; with ``payloads`` off that column is null."""
    n = manifest.count()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            store, name = storage(path)
            with store.open_input_file(name) as file:
                archive = ZipArchive(file)
                places = [json.loads(x) for x in archive.bytes_of(INDEX).splitlines()]
                rows, size = [], 0
                for raw in archive.ranges(DATA, [(p["offset"], p["length"]) for p in places]):
                    row = parsed(zlib.decompress(raw, wbits=31))
                    rows.append(row if payloads else (*row[:-1], None))
                    size += len(row[-1] or b"") * payloads + 200
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return manifest.select("path").repartition(max(1, n)).mapInArrow(lambda b: frugal(work(b)), RECORDS)


def packed_and_read(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORDS of ``pages`` after a round trip through archives in the cluster's shared folder."""
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc")), payloads)
