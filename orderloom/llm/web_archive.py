"""Web archives: WARC records in ZIP packages, read by range without extraction.

A package is a ZIP file with stored, uncompressed members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, a line per record with its place in
the archive. A reader takes the end of the package, follows the central directory (the
ZIP64 one where there is one) to its stored members, reads the index and then the
ranges of the records it wants, near ranges in one read.

Of pages with equal payloads (SHA-1 and length), that of the largest page_id is stored
as a response and the others as revisits that refer to it. Payloads are compared by
digests, counted per (digest, salt) before they meet, so a payload that a third of all
pages share is spread over the salts. Digests that occur once are left out of the
look-up, and Catalyst broadcasts it where the table written is small enough.

Tasks write packages of bounded size under names of their own and report them; the list
of reported packages is checkpointed. What a lost or repeated attempt wrote is in no
list and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import checkpoint_folder, checkpointed, stored, text_of

MIN_BYTES = 0
SALTS = 64
#: A package is closed when it has this many bytes or records.
PACKAGE_BYTES = 64 << 20
PACKAGE_RECORDS = 20_000
#: Ranges that lie together are read at once up to this size.
READ_BYTES = 4 << 20
#: What one task reads, about.
TASK_BYTES = 32 << 20
ROWS_PER_BATCH = 256
DATE = "1970-01-01T00:00:00Z"

# Member names, and the layouts of ZIP's records.
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
END_BYTES, END64_BYTES, LOCATOR64_BYTES, CENTRAL_BYTES, LOCAL_BYTES = 22, 56, 20, 46, 30
ZIP64_EXTRA = 0x0001
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PACKAGES = "package string, n_records bigint, bytes bigint"
ENTRIES = "package string, url string, digest string, offset bigint, length bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


# -- which record is the response ------------------------------------------------------


def planned(pages: DataFrame, min_bytes: int = MIN_BYTES, salts: int = SALTS) -> DataFrame:
    """Rows (page_id, url, payload, sha1, record_type, refers_to) of ``pages``, one each.

    Payloads under ``min_bytes`` are responses all. Of equal payloads, rows of the largest
    page_id are responses (all, if it repeats) and the others revisit it; a null page_id
    is smaller than any, and payloads that only have null ids are responses.
    """
    rows = pages.select("page_id", "url", text_of("html").cast("binary").alias("payload"))
    marked = rows.withColumns(
        {
            "sha1": F.sha1("payload"),
            "_size": F.octet_length("payload"),
            "_salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)),
        }
    )
    key = ["sha1", "_size"]
    cells = marked.groupBy(*key, "_salt").agg(F.max("page_id").alias("_max"), F.count(F.lit(1)).alias("_n"))
    cells = checkpointed(cells.where(F.col("_size") >= min_bytes))
    shared = cells.groupBy(*key).agg(F.max("_max").alias("_response"), F.sum("_n").alias("_n")).where("_n > 1")
    answers = stored(cells.drop("_max", "_n").join(shared.drop("_n"), key))
    revisits = F.coalesce(F.coalesce("page_id", F.col("_response") - 1) != F.col("_response"), F.lit(False))
    return marked.join(answers, [*key, "_salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("_response")).alias("refers_to"),
    )


# -- writing ---------------------------------------------------------------------------


def _lines(*fields: tuple[str, str | None]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode()


def _page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _header_text(value: str | None) -> str | None:
    """A value in one line: control characters and the percent sign are percent-encoded."""
    return value and re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain_text(value: str | None) -> str | None:
    return value and re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the response's header, length included, and no payload."""
    block = b"HTTP/1.1 200 OK\r\n" + _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload))))
    block += b"\r\n" + (b"" if revisit else payload)
    head = b"WARC/1.1\r\n" + _lines(
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _page_uri(page_id)),
        ("WARC-Target-URI", _header_text(url)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", IDENTICAL if revisit else None),
        ("WARC-Refers-To", _page_uri(refers_to) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    )
    return head + b"\r\n" + block + b"\r\n\r\n"


def _gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Package:
    """A package that is being written."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/pages-{uuid.uuid4().hex}.wacz"
        system, path = _file_system(self.uri)
        system.create_dir(posixpath.dirname(path), recursive=True)
        self._stream = system.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._archive = self._zip.open(ARCHIVE, "w", force_zip64=True)
        self._index: list[str] = []
        self.bytes = self.n_records = 0
        info = b"software: orderloom\r\n"
        head = b"WARC/1.1\r\n" + _lines(("WARC-Type", "warcinfo"), ("WARC-Date", DATE), ("Content-Length", str(len(info))))
        self._append(head + b"\r\n" + info + b"\r\n\r\n")

    def _append(self, data: bytes) -> tuple[int, int]:
        packed, at = _gzipped(data), self.bytes
        self._archive.write(packed)
        self.bytes += len(packed)
        return at, len(packed)

    def add(self, url: str | None, digest: str, revisit: bool, data: bytes) -> None:
        offset, length = self._append(data)
        entry = {"digest": f"sha1:{digest}", "mime": "warc/revisit" if revisit else "text/html"}
        entry |= {"offset": str(offset), "length": str(length), "filename": posixpath.basename(ARCHIVE)}
        entry |= {} if url is None else {"url": url}
        self._index.append(f"{re.sub(r'\s', '%20', url or '-')} {re.sub('[^0-9]', '', DATE)} {json.dumps(entry)}")
        self.n_records += 1

    @property
    def full(self) -> bool:
        return self.bytes >= PACKAGE_BYTES or self.n_records >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self._archive.close()
        self._zip.writestr(INDEX, "".join(f"{line}\n" for line in sorted(self._index)))
        self._zip.close()
        self._stream.close()
        return self.uri, self.n_records, self.bytes


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes every row of ``pages`` (page_id, url, html) as a record; returns the list of packages.

    ``folder`` is one that all executors reach, by default in the checkpoint folder. A null
    html is an empty payload. Null ids and urls and repeated rows are records too. An
    empty table writes nothing. Other columns are not used.
    """
    folder = folder or f"{checkpoint_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    schema = pa.schema([("package", pa.string()), ("n_records", pa.int64()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, sha1, kind, refers_to = (value.as_py() for value in row)
                package = package or _Package(folder)
                digest, revisit = base32_digest(sha1), kind == "revisit"
                package.add(url, digest, revisit, record(page_id, url, payload, digest, refers_to, revisit))
                if package.full:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, package.close(), strict=True))], schema)
                    package = None
        if package:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, package.close(), strict=True))], schema)

    return checkpointed(planned(pages, min_bytes).mapInArrow(write, PACKAGES))


# -- reading ---------------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    offset: int
    length: int


def _zip64_values(extra: bytes, *values: int) -> list[int]:
    """``values`` with those that are all ones taken from the ZIP64 field, in order."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            wide = extra[at + 4 : at + 4 + size]
        at += 4 + size
    found = []
    for value in values:
        if value == 0xFFFFFFFF and len(wide) >= 8:
            value, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
        found.append(value)
    return found


def _directory(source: pa.NativeFile) -> tuple[bytes, int, int]:
    """(central directory, number of entries, bytes that precede the ZIP data)."""
    size = source.size()
    tail_at = max(0, size - END_BYTES - 0xFFFF)
    tail = source.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + END_BYTES > len(tail) or at + END_BYTES + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    entries, length, begin = struct.unpack_from("<HLL", tail, at + 10)
    end = tail_at + at
    locator = source.read_at(LOCATOR64_BYTES, end - LOCATOR64_BYTES) if end >= LOCATOR64_BYTES else b""
    if locator.startswith(LOCATOR64):
        # Its record stands where the locator says, or right before it if bytes precede the ZIP data.
        for end64 in (struct.unpack_from("<Q", locator, 8)[0], end - LOCATOR64_BYTES - END64_BYTES):
            wide = source.read_at(END64_BYTES, end64) if 0 <= end64 < size else b""
            if wide.startswith(END64):
                entries, length, begin = struct.unpack_from("<QQQ", wide, 32)
                end = end64
                break
        else:
            raise ValueError("no end of a ZIP64 directory")
    shift = end - length - begin
    if shift < 0:
        raise ValueError("the ZIP directory lies outside the package")
    return source.read_at(length, begin + shift), entries, shift


def stored_members(source: pa.NativeFile) -> list[Member]:
    """The stored members of a package, by its central directory, with the ranges of their data.

    Compressed or encrypted members and folders are left out.
    """
    directory, entries, shift = _directory(source)
    found, at = [], 0
    for _ in range(entries):
        if directory[at : at + 4] != CENTRAL or at + CENTRAL_BYTES > len(directory):
            raise ValueError("the ZIP directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<LLHHH", directory, at + 20)
        (begin,) = struct.unpack_from("<L", directory, at + 42)
        name = directory[at + CENTRAL_BYTES : at + CENTRAL_BYTES + n_name].decode("utf-8", "replace")
        extra = directory[at + CENTRAL_BYTES + n_name : at + CENTRAL_BYTES + n_name + n_extra]
        plain, packed, begin = _zip64_values(extra, plain, packed, begin)
        at += CENTRAL_BYTES + n_name + n_extra + n_comment
        if method or flags & 1 or name.endswith("/"):
            continue
        local = source.read_at(LOCAL_BYTES, begin + shift)
        if not local.startswith(LOCAL):
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        found.append(Member(name, begin + shift + LOCAL_BYTES + n_name + n_extra, packed))
    return found


def package_entries(source: pa.NativeFile) -> Iterator[tuple[str | None, str | None, int, int]]:
    """(url, digest, offset in the package, length) of every record that the package's indexes list."""
    members = stored_members(source)
    archives = {posixpath.basename(m.name): m for m in members if m.name.startswith("archive/")}
    for index in (m for m in members if m.name.startswith("indexes/") and m.name.endswith(".cdxj")):
        for line in source.read_at(index.length, index.offset).decode().split("\n"):
            if "{" not in line:
                continue
            entry = json.loads(line[line.index("{") :])
            archive, offset, length = archives.get(entry["filename"]), int(entry["offset"]), int(entry["length"])
            if archive is None or offset + length > archive.length:
                raise ValueError(f"{entry['filename']} has no bytes {offset} to {offset + length}")
            yield entry.get("url"), entry.get("digest"), archive.offset + offset, length


def _opened(uri: str) -> pa.NativeFile:
    system, path = _file_system(uri)
    return system.open_input_file(path)


def read_index(packages: DataFrame) -> DataFrame:
    """The records of all packages (column package): package, url, digest, offset, length.

    Offsets count from the package's first byte. A package without an index has no rows; a
    file that is no package fails.
    """
    schema = pa.schema(
        [("package", pa.string()), ("url", pa.string()), ("digest", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column(0).to_pylist():
                with _opened(package) as source:
                    rows = [(package, *entry) for entry in package_entries(source)]
                for lo in range(0, len(rows), ROWS_PER_BATCH):
                    columns = zip(*rows[lo : lo + ROWS_PER_BATCH], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
                    )

    return packages.select("package").where("package IS NOT NULL").mapInArrow(read, ENTRIES)


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and what follows them."""
    head, _, rest = block.partition(b"\r\n\r\n")
    fields = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, value in fields}, rest


def parse_record(data: bytes) -> tuple:
    """A record's row, from its bytes as they lie in the archive; fails where a length or digest is wrong."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    if not data.startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    warc, rest = _headers(data)
    block = rest[: int(warc["content-length"])]
    http, payload = _headers(block)
    n_bytes, digest = int(http["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
    kind = warc["warc-type"]
    if kind == "response" and (len(payload) != n_bytes or base32_digest(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError(f"the payload of {warc['warc-record-id']} is damaged")
    page_id = lambda field: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", warc.get(field, ""))) else None
    return (
        page_id("warc-record-id"), _plain_text(warc.get("warc-target-uri")), kind, n_bytes, digest,
        page_id("warc-refers-to"), payload if kind == "response" else None,
    )


def read_records(entries: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at ``entries`` (package, offset, length), rows of ``read_index`` or some of them.

    Payloads are checked against their digests; a revisit's payload is null.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, types, strict=True))[: 7 if payloads else 6])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pa.NativeFile] | None = None
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_PER_BATCH):
                part, rows = whole.slice(lo, ROWS_PER_BATCH), []
                places = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
                while places:
                    package, begin, length = places[0]
                    run, end = 1, begin + length
                    while run < len(places) and places[run][:2] == (package, end) and end + places[run][2] - begin <= READ_BYTES:
                        end += places[run][2]
                        run += 1
                    if opened is None or opened[0] != package:
                        if opened:
                            opened[1].close()
                        opened = package, _opened(package)
                    data = opened[1].read_at(end - begin, begin)
                    for _, at, n in places[:run]:
                        rows.append(parse_record(data[at - begin : at - begin + n])[: len(schema)])
                    del places[:run]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
                )
        if opened:
            opened[1].close()

    # Index rows are narrow: tasks are counted by what they will read, not by the rows' own size.
    entries = checkpointed(entries.select("package", "offset", "length"))
    tasks = -(-(entries.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES) or 1
    placed = entries.repartition(tasks, "package", F.floor(F.col("offset") / F.lit(READ_BYTES)))
    return placed.sortWithinPartitions("package", "offset").mapInArrow(read, ", ".join(RECORDS.split(", ")[: len(schema)]))
