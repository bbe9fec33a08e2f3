"""WARC records in ZIP packages: written by the tasks that hold the pages, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdx`` (where
each record lies), both stored without compression. The reader finds the members through the
central directory, ZIP64 fields included, and reads single records inside the stored member.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .shipping import ship

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: A package is closed when its records reach this size.
PACKAGE_BYTES = 32 << 20
#: Payloads of at least so many bytes are stored once.
MIN_PAYLOAD = 0


# -- ZIP directories ----------------------------------------------------------------------------

def members(file, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (compression method, first byte, length) of the members of a ZIP file.

    ``file`` has seek and read. Reads the end record, the ZIP64 end record if there is one, the
    central directory, and of each member the local header, whose extra field may have another length.
    """
    tail_size = min(size, 22 + 0xFFFF)
    file.seek(size - tail_size)
    tail = file.read(tail_size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)  # these four bytes can also stand in the comment
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator_at = size - tail_size + at - 20
    if locator_at >= 0:
        file.seek(locator_at)
        locator = file.read(20)
        if locator[:4] == b"PK\x06\x07":
            file.seek(struct.unpack_from("<Q", locator, 8)[0])
            end = file.read(56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("broken ZIP64 end of central directory")
            count, length, start = struct.unpack_from("<QQQ", end, 32)
    file.seek(start)
    directory = file.read(length)
    found, at = {}, 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n, extra, comment = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n].decode()
        field, end = at + 46 + n, at + 46 + n + extra
        while field + 4 <= end:
            kind, wide = struct.unpack_from("<HH", directory, field)
            if kind == 1:  # ZIP64: only the values that did not fit stand here, in this order
                place = field + 4
                if plain == 0xFFFFFFFF:
                    place += 8
                if packed == 0xFFFFFFFF:
                    packed, = struct.unpack_from("<Q", directory, place)
                    place += 8
                if local == 0xFFFFFFFF:
                    local, = struct.unpack_from("<Q", directory, place)
            field += 4 + wide
        file.seek(local)
        header = file.read(30)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("broken local header")
        n_local, extra_local = struct.unpack_from("<HH", header, 26)
        found[name] = (method, local + 30 + n_local + extra_local, packed)
        at = end + comment
    return found


def read_range(file, start: int, length: int) -> bytes:
    file.seek(start)
    return file.read(length)


# -- WARC records -------------------------------------------------------------------------------

def _line(value: object) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


def record(page_id: object, url: str | None, payload: bytes, refers_to: object = None) -> bytes:
    """One gzip member with a response record, or with a revisit record if ``refers_to`` is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {_line(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest}"]
    head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
             "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


def parse_record(packed: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one gzip member; names in small letters."""
    plain = zlib.decompress(packed, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = lambda lines: {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    warc = fields(head.decode().split("\r\n")[1:])
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http.decode().split("\r\n")[1:]), payload


# -- jobs ---------------------------------------------------------------------------------------

class _Package:
    """A ZIP package under construction: records go to the stream at once, index lines wait."""

    def __init__(self, root: str):
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"  # a task that runs again writes files of its own
        self.path = f"{root}/{name}"
        self.stream = store.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, page_id: object, url: str | None, payload: bytes, refers_to: object) -> None:
        packed = record(page_id, url, payload, refers_to)
        self.data.write(packed)
        self.lines.append(f"{'' if page_id is None else page_id} {self.size} {len(packed)}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines)


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_archives(pages: DataFrame, root: str, scratch: Scratch, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_payload: int = MIN_PAYLOAD, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write all pages to packages under ``root``, a folder that all executors reach; returns (path, n_records).

    Pages with equal payloads of at least ``min_payload`` bytes become one response, that of the largest id,
    and revisits. The list of packages is written too, so that it names the files of tasks that succeeded alone.
    """
    ship(pages.sparkSession)
    root = _uri(root)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = rows.where(F.length("payload") >= min_payload).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    linked = rows.join(first.where("n > 1").select("digest", "first"), "digest", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") != F.col("first"), F.col("first")).when(
            F.col("page_id").isNull(), F.col("first")).alias("refers_to"))

    def write(batches):
        package, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                package = package or _Package(root)
                package.add(*row)
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                                         names=["path", "n_records"])

    return scratch.keep(linked.mapInArrow(write, "path string, n_records bigint"), "packages")


def _records(path: str) -> Iterator[tuple]:
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_file(place) as file:
        found = members(file, file.size())
        (data_method, data, _), (index_method, index, n) = found[DATA], found[INDEX]
        if data_method or index_method:
            raise ValueError(f"{path}: members must be stored")
        for line in read_range(file, index, n).decode().splitlines():
            _, start, length = line.rsplit(" ", 2)
            warc, http, payload = parse_record(read_range(file, data + int(start), int(length)))
            digest = warc["warc-payload-digest"].removeprefix("sha1:")
            kind = warc["warc-type"]
            if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{path}: payload and digest differ in {warc['warc-record-id']}")
            number = lambda field: int(v) if (v := warc.get(field, "<urn:page:>")[10:-1]) else None
            yield number("warc-record-id"), int(http["content-length"]), digest, kind, number("warc-refers-to"), payload


def read_archives(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to[, payload]) of all records in the packages.

    One package is one row of ``packages`` and is read by one task at a time, record by record.
    """
    ship(packages.sparkSession)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"

    def out(rows):
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns + ([pa.array([r[5] for r in rows], pa.binary())] if payloads else []),
                                          names=names + ["payload"] * payloads)

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for row in _records(path):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    n = packages.count()
    spread = packages.select("path").repartition(max(1, n))
    return spread.mapInArrow(read, schema + (", payload binary" if payloads else ""))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages`` and read every record back.

    Null texts are empty payloads, null urls leave out the address; a null id is written as an empty one and
    revisits the response of its payload if another page has it. Repeated rows are written as often as they occur; extra
    columns are ignored; an empty table gives no package and an empty result.
    """
    scratch = Scratch(spark, "archives")
    return read_archives(write_archives(pages, scratch.path("packages"), scratch))
