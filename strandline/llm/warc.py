"""WARC records in ZIP packages: writer, and a reader that goes by the archive's directories.

A package is a ZIP whose members are stored, not deflated: ``records.warc.gz``
(one gzip member per WARC record) and ``index.cdx`` (offset, length and id of
each record). The reader finds the end-of-directory record, follows the ZIP64
locator when there is one, reads the central directory, and reads each record
as a byte range of the package; nothing is unpacked to files.

Packages are written by Spark's text writer, one package per file: the writer's
line end is the one-byte archive comment, so each file is a valid ZIP. They lie
in the shared folder, and a lost executor's packages are written again by the
task's next attempt.

Defined results: a NULL html is an empty payload, written as a response. Pages
with a NULL page_id have no id header and read back as NULL; they are revisits
if an equal payload has an id. Rows that share the smallest id of a payload are
all responses. Extra columns are ignored. An empty table gives no packages.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, rewritten
from strandline.session import scratch_dir

#: Payloads smaller than this are never revisits.
REVISIT_BYTES = 100
#: A package is closed once its records reach this size.
PACKAGE_BYTES = 16 << 20

RECORD_MEMBER, INDEX_MEMBER = "records.warc.gz", "index.cdx"
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

_EOCD, _EOCD64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_U32, _U16 = 0xFFFFFFFF, 0xFFFF


# ---- ranges ---------------------------------------------------------------

class Ranges:
    """Byte ranges of a package: of a buffer, or of a seekable file."""

    def __init__(self, source):
        self._file = None if isinstance(source, (bytes, bytearray, memoryview)) else source
        self._view = memoryview(source) if self._file is None else None
        self.size = len(self._view) if self._file is None else source.seek(0, io.SEEK_END)

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"range {offset}+{length} is outside the package of {self.size} bytes")
        if self._file is None:
            return bytes(self._view[offset:offset + length])
        self._file.seek(offset)
        return self._file.read(length)


class Member(NamedTuple):
    name: str
    method: int
    offset: int  # of the data, not of the local header
    size: int


def zip_members(data: Ranges) -> list[Member]:
    """The package's members, by its central directory."""
    tail_at = max(0, data.size - 22 - _U16)
    tail = data.read(tail_at, data.size - tail_at)
    at = tail.rfind(_EOCD)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(_EOCD, 0, at)
    if at < 0:
        raise ValueError("no end-of-directory record")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= 20 and (loc := data.read(end - 20, 20))[:4] == _LOCATOR64:
        record = data.read(struct.unpack_from("<Q", loc, 8)[0], 56)
        if record[:4] != _EOCD64:
            raise ValueError("the ZIP64 locator points to no ZIP64 record")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, p = data.read(start, size), [], 0
    for _ in range(count):
        if directory[p:p + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", directory, p + 10)[0]
        packed, full = struct.unpack_from("<II", directory, p + 20)
        n_name, n_extra, n_note = struct.unpack_from("<HHH", directory, p + 28)
        offset = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46:p + 46 + n_name].decode("utf-8")
        extra, q = directory[p + 46 + n_name:p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            tag, length = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # ZIP64: only the fields that do not fit above, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, q + 4))
                full = next(wide) if full == _U32 else full
                packed = next(wide) if packed == _U32 else packed
                offset = next(wide) if offset == _U32 else offset
            q += 4 + length
        local = data.read(offset, 30)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header for {name}")
        l_name, l_extra = struct.unpack_from("<HH", local, 26)
        members.append(Member(name, method, offset + 30 + l_name + l_extra, packed))
        p += 46 + n_name + n_extra + n_note
    return members


# ---- records --------------------------------------------------------------

def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


def package(records: list[tuple[str, bytes]]) -> bytes:
    """A ZIP package of (index key, WARC record) pairs; its comment is one line end."""
    body, index, at = io.BytesIO(), [], 0
    for key, record in records:
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        at += body.write(piece := squeeze.compress(record) + squeeze.flush())
        index.append(f"{at - len(piece)} {len(piece)} {key}\n")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for name, data in ((RECORD_MEMBER, body.getbuffer()), (INDEX_MEMBER, "".join(index).encode())):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=True) as f:
                f.write(data)
        z.comment = b"\n"
    return out.getvalue()


def read_package(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, payload) of every indexed record, each read as a range of the package."""
    data = Ranges(source)
    members = {m.name: m for m in zip_members(data)}
    for m in members.values():
        if m.method:
            raise ValueError(f"member {m.name} is not stored")
    records, index = members[RECORD_MEMBER], members[INDEX_MEMBER]
    for line in data.read(index.offset, index.size).decode().splitlines():
        offset, length, _ = line.split(" ", 2)
        yield parse_record(zlib.decompress(data.read(records.offset + int(offset), int(length)), 31))


# ---- Spark ----------------------------------------------------------------

def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to): every page with the response that it revisits, if any."""
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", url.alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    firsts = (rows.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"))
    # written first: only digests that repeat; with its true size known, the join moves the pages only if it must
    firsts = rewritten(firsts.select("digest", "first"), "warc-firsts")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_packages(pages: DataFrame, path: str, package_bytes: int = PACKAGE_BYTES) -> None:
    """Write the pages as ZIP packages below ``path``, one file each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0

        def flush() -> pa.RecordBatch:
            # the text writer adds the line end that is the archive's comment
            return pa.RecordBatch.from_pydict({"value": pa.array([package(records)[:-1]], pa.binary())})

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*batch.columns):
                record = warc_record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8"), digest.as_py(),
                                     refers_to.as_py())
                records.append((str(page_id.as_py()), record))
                size += len(record)
                if size >= package_bytes:
                    yield flush()
                    records, size = [], 0
        if records:
            yield flush()

    rows = plan_records(pages).mapInArrow(pack, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.mode("overwrite") \
        .option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


def read_packages(spark, path: str) -> DataFrame:
    """One row per record of the packages below ``path``. A response's digest and size are taken from its
    payload and must agree with its header; a revisit's are those of its header."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])

        def urn(value: str | None) -> int | None:
            return None if value is None else int(value.removeprefix("<urn:page:").removesuffix(">"))

        for batch in batches:
            for content in batch.column(0):
                if not content.as_buffer().size:
                    continue
                rows = []
                for head, payload in read_package(memoryview(content.as_buffer())):
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response" and (
                            hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"payload of {head.get('WARC-Record-ID')} does not match its header")
                    rows.append((urn(head.get("WARC-Record-ID")), size, digest, head["WARC-Type"],
                                 urn(head.get("WARC-Refers-To"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                 schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, READ_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to packages in the shared folder and read them back."""
    bounded_batches(pages.sparkSession)
    path = scratch_dir(pages.sparkSession, "warc")
    write_packages(pages, path)
    return read_packages(pages.sparkSession, path)
