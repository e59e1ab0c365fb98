"""WARC records in ZIP archives: a writer, and a reader that takes byte ranges.

An archive is a ZIP file of stored members: ``archive/data.warc.gz``, a gzip member per
record, and ``indexes/index.cdx``, a JSON line per record with its range. The reader
parses the end record, its ZIP64 form and the central directory, finds the members'
bytes, reads the index, and then only the ranges of the records; nothing is unpacked to
disk and members are never read as a whole.

Archives are written by the tasks that hold the rows, under names that no other attempt
uses, and listed in a table that holds the successful attempts alone. They lie in the
shared folder (``spark.checkpoint.dir``) unless another is given; any file system that
pyarrow can open will do.

Of pages with equal payloads (SHA-1 and length) the smallest ``page_id`` is the response
and the others are revisits of it, if they are at least ``min_bytes`` long. Null html is an
empty payload, a null url writes no target. A null ``page_id`` revisits like any other;
pages without any id among their copies are responses. Repeated rows each get a record,
and those of the smallest id are all responses. Other columns are not written."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odotrack.llm.common import or_empty
from odotrack.session import shared_folder, stage

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes after which an archive is closed, and bytes read at a time.
ROLL, SPAN = 1 << 27, 1 << 22
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Writing ----------------------------------------------------------------------


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": url and url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": "sha1:" + base32(hashlib.sha1(payload).digest()),
        "WARC-Refers-To": _record_id(refers_to) if revisit else None,
        "WARC-Profile": REVISIT if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Stream:
    """What ``zipfile`` may do with an output that cannot seek."""

    def __init__(self, out):
        self.write, self.flush = out.write, out.flush


def write_archive(uri: str, records: Iterator[tuple[dict, bytes]], roll: int = ROLL) -> tuple[int, int]:
    """Writes (index entry, record) pairs until the archive is full or they end; gives the
    number of records and their bytes. ``records`` must have a first one."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    at, lines = 0, []
    with system.open_output_stream(path) as out, zipfile.ZipFile(_Stream(out), "w", zipfile.ZIP_STORED) as package:
        with package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
            for entry, data in records:
                packed = _gzipped(data)
                member.write(packed)
                lines.append(json.dumps(entry | {"offset": at, "length": len(packed)}))
                at += len(packed)
                if at >= roll:
                    break
        with package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write("".join(line + "\n" for line in lines).encode())
    return len(lines), at


def _writer(folder: str, roll: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[dict, bytes]]:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch[n] for n in ("page_id", "url", "html", "refers_to"))):
                    payload = html.as_py().encode("utf-8", "surrogatepass")
                    data = record(page_id.as_py(), url.as_py(), payload, refers_to.as_py())
                    yield {"page_id": page_id.as_py()}, data

        all_records = records()
        for first in all_records:

            def more(head=first):
                yield head
                yield from all_records

            uri = f"{folder}/{uuid.uuid4().hex}.wacz"
            n, size = write_archive(uri, more(), roll)
            yield pa.RecordBatch.from_pydict(
                {"archive": [uri], "n_records": [n], "n_bytes": [size]},
                pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]),
            )

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, roll: int = ROLL) -> DataFrame:
    """Writes (page_id, url, html) and gives the table of archives: (archive, n_records,
    n_bytes)."""
    folder = folder or f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    html = or_empty(F.col("html"))
    rows = pages.select("page_id", "url", html.alias("html"))
    marks = pages.select("page_id", F.sha1(F.encode(html, "UTF-8")).alias("sha1"), F.octet_length(html).alias("n"))
    groups = marks.filter(F.col("n") >= min_bytes).groupBy("sha1", "n").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("copies")
    )
    revisits = (
        marks.join(groups.filter("copies > 1 and refers_to is not null"), ["sha1", "n"])
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("__flagged_id"), F.col("sha1").alias("__sha1"), "refers_to")
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("__flagged_id")) & (F.sha1(F.encode("html", "UTF-8")) == F.col("__sha1"))
    marked = rows.join(revisits, same, "left").select("page_id", "url", "html", "refers_to")
    written = marked.mapInArrow(_writer(folder, roll), "archive string, n_records long, n_bytes long")
    return stage(written)  # once: another run of the tasks would write other files


# Reading ----------------------------------------------------------------------


def _wide(extra: bytes, wanted: list[int | None]) -> list[int]:
    """Sizes and offset of a directory entry, the ones at their limit from the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(values) if v == 0xFFFFFFFF else v for v in wanted]
        at += 4 + size
    return wanted


class ZipDirectory:
    """Members of a ZIP file, from its directory at the end; reads by range."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail_at = max(0, size - 65557)  # the end record and the longest comment
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\5\6")
        if end < 0:
            raise ValueError("not a ZIP file")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        locator = tail_at + end - 20
        if locator >= 0 and (found := self.read(locator, 20))[:4] == b"PK\6\7":
            wide_at = struct.unpack_from("<Q", found, 8)[0]
            wide = self.read(wide_at, 56)
            if wide[:4] != b"PK\6\6":
                raise ValueError("ZIP64 end record not found")
            count, length, start = struct.unpack_from("<QQQ", wide, 32)
        self.members = dict(self._entries(self.read(start, length), count))

    def read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the file ends early")
        return data

    @staticmethod
    def _entries(directory: bytes, count: int) -> Iterator[tuple[str, tuple[int, int, int]]]:
        at = 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\1\2":
                raise ValueError("bad directory entry")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
            (header,) = struct.unpack_from("<I", directory, at + 42)
            name_at = at + 46
            name = directory[name_at : name_at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[name_at + n_name : name_at + n_name + n_extra]
            full, packed, header = _wide(extra, [full, packed, header])
            yield name, (header, packed, method)
            at = name_at + n_name + n_extra + n_comment

    def locate(self, name: str) -> tuple[int, int]:
        """First byte and length of a stored member."""
        header, length, method = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is compressed: its records cannot be read by range")
        local = self.read(header, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError("bad local header")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return header + 30 + n_name + n_extra, length


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def parse_record(data: bytes) -> dict:
    """One unpacked record. Digest and size are computed for responses, and taken from
    the header for revisits, which have no payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(x) if (x := fields.get(name, "").rpartition(":")[2].rstrip(">")) else None
    stated = fields["warc-payload-digest"].rpartition(":")[2]
    revisit = fields["warc-type"] == "revisit"
    digest = stated if revisit else base32(hashlib.sha1(payload).digest())
    if digest != stated:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": number("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_bytes": int(_fields(http)["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "refers_to": number("warc-refers-to"),
        "payload": None if revisit else payload,
    }


def read_archive(uri: str) -> Iterator[dict]:
    """The records of one archive, in order of its index."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        package = ZipDirectory(file)
        index_at, index_length = package.locate(INDEX)
        data_at, _ = package.locate(DATA)
        entries = [json.loads(line) for line in package.read(index_at, index_length).splitlines()]
        i = 0
        while i < len(entries):
            start = end = entries[i]["offset"]
            j = i
            while j < len(entries) and entries[j]["offset"] == end and (j == i or end - start < SPAN):
                end += entries[j]["length"]
                j += 1
            span = package.read(data_at + start, end - start)
            for entry in entries[i:j]:
                at = entry["offset"] - start
                yield parse_record(zlib.decompress(span[at : at + entry["length"]], 31))
            i = j


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """The records of all archives of the column ``archive``, with their payloads if they
    are wanted. Every archive is a task's worth of work."""
    schema = RECORD if payload else pa.schema([f for f in RECORD if f.name != "payload"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                rows, size = [], 0
                for row in read_archive(uri):
                    size += row["payload_bytes"]
                    rows.append({n: row[n] for n in schema.names})
                    if len(rows) >= 1000 or payload and size > SPAN:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    types = {"int64": "long", "string": "string", "binary": "binary"}
    ddl = ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema)
    dealt = archives.select("archive").repartition(min(10_000, max(1, archives.count())), "archive")
    return dealt.mapInArrow(run, ddl)
