"""WARC archives: written from pages, normalised to one gzip member a record, read by index.

``write_archives`` writes monolithic archives: one gzip stream a file, as some
crawlers leave them.  ``normalise`` inflates each stream once, front to back, and
writes every record again as a gzip member of its own, together with a sidecar
index of (record id, type, offset, length).  ``read_records`` reads records at
their offsets.  Files go to a shared folder under names of their own for each
attempt, and only those that a finished task has listed count; the rest of a
lost executor's work is never read.

Defined results: a null html is an empty payload; a null url becomes the
record's own id; null ``page_id`` is allowed and told apart from all others;
of repeated rows with the least ``page_id`` of their payload each is a response;
an empty table gives no archive and no records; only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.storage import written
from seriesmill.session import work_path

LEAST_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
MOST_TASKS = 10_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "page_id long, url string, digest string, payload_bytes long, refers_to long, is_revisit boolean, html string"
FILES = "path string, records long"
INDEX = "page_id long, record_type string, path string, offset long, length long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    own = name.rpartition(":")[2].rstrip(">")
    return None if own == "none" else int(own)


def header(row: dict) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header) of a record."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    size = len(http) + (0 if row["is_revisit"] else row["payload_bytes"])
    own = record_id(row["page_id"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['is_revisit'] else 'response'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Target-URI: {quote(row['url'], safe=':/?#[]@!$&()*+,;=%~') if row['url'] else own[1:-1]}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
    ]
    if row["is_revisit"]:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}", "", ""]
    return "\r\n".join(lines).encode(), http


def with_fates(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with digest, size and what they refer to.

    Equal payloads are found on digests alone; the html crosses one exchange, by
    page, so a payload that many pages share makes no crowded task.
    """
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("payload_bytes"),
        text.alias("html"),
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= LEAST_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    later = rows.filter(F.col("payload_bytes") >= LEAST_REVISIT_BYTES).select("page_id", "digest").join(
        shared.select("digest", "refers_to"), "digest"
    ).filter("page_id > refers_to").distinct()
    fates = later.select("page_id", "digest", "refers_to")
    return rows.join(fates, ["page_id", "digest"], "left").withColumn("is_revisit", F.col("refers_to").isNotNull())


class Archive:
    """A gzip stream in a new file of the shared folder; ``member`` starts another one."""

    def __init__(self, folder: str, ending: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{ending}"
        files, name = storage(self.path)
        files.create_dir(name.rpartition("/")[0], recursive=True)
        self.file = files.open_output_stream(name, compression=None)
        self.size = self.records = 0
        self.packer = None

    def write(self, data: bytes) -> None:
        if self.packer is None:
            self.packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        for low in range(0, len(data), CHUNK):
            self._put(self.packer.compress(data[low : low + CHUNK]))

    def member(self) -> None:
        if self.packer is not None:
            self._put(self.packer.flush())
            self.packer = None

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.member()
        self.file.close()


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, records) of the monolithic archives made of rows with the columns of ``RECORDS``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None

        def closed() -> pa.RecordBatch:
            archive.close()
            return pa.RecordBatch.from_pydict({"path": [archive.path], "records": [archive.records]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if archive is None:
                    archive = Archive(folder, ".mono.warc.gz")
                own, http = header(row)
                archive.write(own + http)
                if not row["is_revisit"]:
                    archive.write(row["html"].encode())
                archive.write(b"\r\n\r\n")
                archive.records += 1
                if archive.size >= archive_bytes:
                    yield closed()
                    archive = None
        if archive is not None:
            yield closed()

    ordered = rows.select(*(f.split()[0] for f in RECORDS.split(", ")))
    return written(ordered.mapInArrow(run, FILES), "archives")


class Inflated:
    """The bytes of a gzip file of any number of members, inflated once from front to back."""

    def __init__(self, file):
        self.file, self.left = file, b""
        self.unpacker = zlib.decompressobj(31)
        self.buffer = bytearray()

    def _more(self) -> bool:
        data = self.left or self.file.read(CHUNK)
        if not data:
            return False
        if self.unpacker.eof:
            self.unpacker = zlib.decompressobj(31)
        self.buffer += self.unpacker.decompress(data, CHUNK)
        self.left = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
        return True

    def line(self) -> bytes:
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError("an archive ends within a header")
                return b""
        out = bytes(self.buffer[: at + 2])
        del self.buffer[: at + 2]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self._more():
                raise ValueError("an archive ends within a record")
            out = bytes(self.buffer[:size])
            del self.buffer[:size]
            size -= len(out)
            if out:
                yield out


def records(stream: Inflated) -> Iterator[tuple[dict[str, str], bytes, Iterator[bytes]]]:
    """(fields, header bytes, block in chunks) of each record; the block must be read before the next."""
    while first := stream.line():
        if first == b"\r\n":
            continue
        lines, fields = [first], {}
        while (line := stream.line()) != b"\r\n":
            if not line:
                raise ValueError("an archive ends within a header")
            lines.append(line)
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, b"".join([*lines, b"\r\n"]), stream.take(int(fields["content-length"]))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """The index of new archives in which every record is a gzip member of its own.

    Each archive is inflated once and held a chunk at a time.  The index also lies
    beside each new archive, one JSON line a record.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = storage(path)
                out = Archive(folder, ".warc.gz")
                entries = []
                with files.open_input_stream(name, compression=None) as source:
                    for fields, head, block in records(Inflated(source)):
                        start = out.size
                        out.write(head)
                        for chunk in block:
                            out.write(chunk)
                        out.write(b"\r\n\r\n")
                        out.member()
                        entries.append(
                            {
                                "page_id": page_of(fields["warc-record-id"]),
                                "record_type": fields["warc-type"],
                                "path": out.path,
                                "offset": start,
                                "length": out.size - start,
                            }
                        )
                out.close()
                files, name = storage(out.path + ".index")
                with files.open_output_stream(name, compression=None) as sidecar:
                    sidecar.write("".join(json.dumps(e) + "\n" for e in entries).encode())
                yield pa.RecordBatch.from_pylist(
                    entries,
                    pa.schema(
                        [("page_id", pa.int64()), ("record_type", pa.string()), ("path", pa.string()),
                         ("offset", pa.int64()), ("length", pa.int64())]
                    ),
                )

    # A row is a whole archive: a set number of tasks, which is not cut down for small rows.
    spread = archives.repartition(min(MOST_TASKS, max(1, archives.count())), F.col("path"))
    return written(spread.mapInArrow(run, INDEX), "warc-index")


_LENGTH = re.compile(rb"Content-Length: (\d+)")


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records at the offsets of an index, each checked against its payload digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            rows = []
            for entry in batch.to_pylist():
                if entry["path"] != path:
                    if file is not None:
                        file.close()
                    path = entry["path"]
                    files, name = storage(path)
                    file = files.open_input_file(name)
                file.seek(entry["offset"])
                whole = zlib.decompress(file.read(entry["length"]), 31)
                head, _, block = whole.partition(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                size = int(_LENGTH.search(http)[1])
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"a record of {path} is damaged")
                rows.append(
                    (
                        page_of(fields["WARC-Record-ID"]), size, digest, kind,
                        page_of(refers) if refers else None,
                        payload if with_payload and kind == "response" else None,
                    )
                )
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                    names=[f.split()[0] for f in READ.split(", ")],
                )
        if file is not None:
            file.close()

    return index.mapInArrow(run, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as monolithic archives, normalise these, and read every record back."""
    folder = work_path(pages.sparkSession, "warc")
    index = normalise(write_archives(with_fates(pages), folder + "/mono"), folder + "/records")
    return read_records(index, with_payload=False).drop("payload")
