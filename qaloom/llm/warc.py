"""WARC records in ZIP packages: writing with revisits of equal payloads, and reading by ranges without extraction.

A package is a ZIP file whose members are stored, not deflated: WARC files of one gzip member per record, and one index
with the place of every record. A reader fetches the end of the package, parses the central directory (ZIP64 included),
reads the index, and then fetches only ranges that hold records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.storage import materialize, new_folder

MEMBER, PACKAGE, RANGE = 4 << 20, 64 << 20, 1 << 20
LEAST = 100
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- packages -----------------------------------------------------------------
def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it; tasks on any machine can use it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder) if ":/" in folder else f"file://{folder}")


class Package:
    """A ZIP package under writing: members are stored whole, the index comes last."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Stream(self.out), "w", zipfile.ZIP_STORED)
        self.index: list[str] = []
        self.members, self.size = 0, 0
        self.buffer, self.places = io.BytesIO(), []

    def add(self, record: bytes) -> None:
        self.places.append((self.buffer.tell(), len(record)))
        self.buffer.write(record)
        if self.buffer.tell() >= MEMBER:
            self._member()

    def _member(self) -> None:
        name = f"archive/data-{self.members:05d}.warc.gz"
        self.zip.writestr(name, self.buffer.getvalue())
        self.index += [f"{name} {at} {length}\n" for at, length in self.places]
        self.size += self.buffer.tell()
        self.members += 1
        self.buffer, self.places = io.BytesIO(), []

    def close(self) -> None:
        if self.places:
            self._member()
        self.zip.writestr("indexes/records.idx", "".join(self.index))
        self.zip.close()
        self.out.close()


class _Stream(io.RawIOBase):
    """What ``zipfile`` needs of a stream that cannot seek."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(data)
        return len(data)


def directory(file) -> list[tuple[str, int, int, int, int]]:
    """Entries of a package's central directory: name, method, size, compressed size, place of the local header.

    The record at the end names the directory; where a number there does not fit, the ZIP64 record does, found by its
    locator. The same holds for each entry and its ZIP64 extra field.
    """
    size = file.size()
    tail_at = max(0, size - 65_557 - 20)
    tail = _fetch(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package")
    count, length, at = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (record,) = struct.unpack_from("<Q", tail, end - 12)
        count, length, at = struct.unpack_from("<QQQ", _fetch(file, record, 56), 32)
    elif 0xFFFF == count or 0xFFFFFFFF in (length, at):
        raise ValueError("the ZIP64 locator is missing")
    raw, pos, out = _fetch(file, at, length), 0, []
    for _ in range(count):
        if raw[pos : pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, pos + 8)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", raw, pos + 20)
        (local,) = struct.unpack_from("<I", raw, pos + 42)
        name = raw[pos + 46 : pos + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = raw[pos + 46 + n : pos + 46 + n + m], 0
        while e + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, e)
            if tag == 1:
                wide = list(struct.unpack_from(f"<{width // 8}Q", extra, e + 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            e += 4 + width
        out.append((name, method, plain, packed, local))
        pos += 46 + n + m + k
    return out


def stored_at(file, local: int) -> int:
    """Where the bytes of a member begin, behind its local header."""
    head = _fetch(file, local, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n, m = struct.unpack_from("<HH", head, 26)
    return local + 30 + n + m


def _fetch(file, at: int, length: int) -> bytes:
    file.seek(at)
    return file.read(length)


# --- records ------------------------------------------------------------------
def record(page_id, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to) -> bytes:
    """A response, or a revisit if ``refers_to`` is given, as one gzip member."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def parse(raw: bytes) -> dict:
    """A record's page_id, url, payload (None in a revisit), payload_bytes, payload_digest, record_type and refers_to."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    (length,) = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest = field["warc-payload-digest"].removeprefix("sha256:")
    if field["warc-type"] == "response":
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload differs from its digest")
    else:
        payload = None
    page = lambda x: int(x[10:-1]) if x and x[10:-1] else None
    return {
        "page_id": page(field["warc-record-id"]), "url": field.get("warc-target-uri"), "payload": payload, "payload_bytes": length,
        "payload_digest": digest, "record_type": field["warc-type"], "refers_to": page(field.get("warc-refers-to")),
    }


# --- tables -------------------------------------------------------------------
def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages (page_id, url, html) with n_bytes, digest and refers_to, which is null in responses.

    Of equal payloads of at least ``least`` bytes the smallest page_id is the response; all rows with that id are. A
    null page_id is never referred to, and a page without one revisits like others. Digests are made and grouped
    without the payloads; only page numbers travel back, joined on the page, so no group of copies meets in one task.
    """
    text = F.coalesce("html", F.lit(""))
    small = materialize(pages.select("page_id", F.sha2(text.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("bigint").alias("n_bytes")), "digests")
    large = small.filter(F.col("n_bytes") >= least)
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    again = large.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to").distinct()
    full = pages.select("page_id", "url", "html", F.sha2(text.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("bigint").alias("n_bytes"))
    joined = full.join(again, full["page_id"].eqNullSafe(again["p"]) & (full["digest"] == again["d"]), "left")
    return joined.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "digest", "n_bytes", "refers_to")


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; the table of finished packages: path, n_records.

    A task that is run again writes under new names, and only what a finished task reports is in the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        package, n, path = None, 0, ""

        def done() -> pa.RecordBatch:
            package.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path, n = f"{uuid.uuid4().hex}.zip", 0
                    package = Package(store, f"{root}/{path}")
                payload = (row["html"] or "").encode() if row["refers_to"] is None else b""
                package.add(record(row["page_id"], row["url"], payload, row["digest"], row["n_bytes"], row["refers_to"]))
                n += 1
                if package.size >= PACKAGE:
                    yield done()
                    package = None
        if package is not None:
            yield done()

    return materialize(pages.mapInArrow(run, "path string, n_records bigint"), "packages")


def locate(packages: DataFrame, folder: str) -> DataFrame:
    """Ranges that hold records: path, at, lengths (of the records in it, one after another)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(f"{root}/{path}") as file:
                    entries = {}
                    for name, method, _, packed, local in directory(file):
                        if method:
                            raise ValueError(f"{name} is not stored")
                        entries[name] = (stored_at(file, local), packed)
                    ranges: list[tuple[int, list[int]]] = []
                    for name, (at, length) in entries.items():
                        if not name.startswith("indexes/"):
                            continue
                        for line in _fetch(file, at, length).decode().splitlines():
                            member, start, size = line.rsplit(" ", 2)
                            start, size = entries[member][0] + int(start), int(size)
                            if ranges and ranges[-1][0] + sum(ranges[-1][1]) == start and sum(ranges[-1][1]) < RANGE and len(ranges[-1][1]) < 1000:
                                ranges[-1][1].append(size)
                            else:
                                ranges.append((start, [size]))
                yield pa.RecordBatch.from_pydict(
                    {"path": pa.array([path] * len(ranges), pa.string()), "at": pa.array([a for a, _ in ranges], pa.int64()),
                     "lengths": pa.array([x for _, x in ranges], pa.list_(pa.int64()))}
                )

    return packages.select("path").mapInArrow(run, "path string, at bigint, lengths array<bigint>")


RECORD = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_packages(packages: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the packages, read range by range; without ``payloads`` the payload column is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['path']}") as file:
                    raw = _fetch(file, row["at"], sum(row["lengths"]))
                out, at = [], 0
                for length in row["lengths"]:
                    out.append(parse(raw[at : at + length]))
                    at += length
                    if not payloads:
                        out[-1]["payload"] = None
                yield pa.RecordBatch.from_pylist(out, schema)

    places = locate(packages, folder)
    n = places.sparkSession.sparkContext.defaultParallelism
    return places.repartition(4 * n, F.xxhash64("path", "at")).mapInArrow(run, RECORD)


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> tuple[DataFrame, str]:
    """Write all pages to packages in a folder (one of the shared folder by default): the packages and the folder.

    ``pages`` has page_id, url and html; other columns are left out. Null html is an empty payload. An empty table
    gives no packages.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    return write_packages(with_revisits(pages.select("page_id", "url", "html"), least), folder), folder
