"""WARC records in ZIP-packaged archives, written and read by byte ranges.

An archive is a ZIP file whose members are stored, not compressed:
``archive/data.warc.gz`` with one gzip member for each record,
``indexes/index.cdxj`` with a line for each record, and ``datapackage.json``.
The reader finds the central directory from the end of the file, by the ZIP64
records where there are any, locates stored members by their local headers, and
fetches ranges of records by the index. Nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, stage_path, stage_table, width

ARCHIVE_BYTES = 64 << 20
BROADCAST_DIGESTS = 500_000
RANGE_BYTES = 4 << 20
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6f2e8f3e-0c55-5d0a-9c8f-3a8b1a3d7c11")
U16, U32 = 0xFFFF, 0xFFFFFFFF


# ---------------------------------------------------------------- ZIP


@dataclass
class Entry:
    """A member: its name, method, checksum, sizes, and where its local header is."""

    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int


def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> Iterator[bytes]:
    """The bytes of a ZIP file with stored members; ``zip64`` writes ZIP64 fields even where sizes don't need them."""
    at, central = 0, []
    for name, data in members:
        raw, crc = name.encode(), zlib.crc32(data)
        big = zip64 or len(data) >= U32 or at >= U32
        size = U32 if big else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        head = struct.pack("<4s5H3I2H", b"PK\3\4", 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra)) + raw + extra
        yield head
        yield data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if big else b""
        central.append(struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, U32 if big else at) + raw + extra)
        at += len(head) + len(data)
    table = b"".join(central)
    yield table
    n = len(members)
    if zip64 or n >= U16 or at >= U32 or len(table) >= U32:
        yield struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(table), at)
        yield struct.pack("<4sIQI", b"PK\6\7", 0, at + len(table), 1)
        yield struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, U16, U16, U32, U32, 0)
    else:
        yield struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, n, n, len(table), at, 0)


class ZipArchive:
    """A ZIP file that is read by ranges. ``files`` and ``place`` name it as pyarrow does."""

    def __init__(self, path: str):
        files, place = pafs.FileSystem.from_uri(path)
        self.path, self._file = path, files.open_input_file(place)
        self.entries = self._directory()

    def read(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        data = self._file.read(size)
        if len(data) != size:
            raise ValueError(f"{self.path} ends too early")
        return data

    def _directory(self) -> dict[str, Entry]:
        end = self._file.size()
        tail_at = max(0, end - 22 - U16)
        tail = self.read(tail_at, end - tail_at)
        at = tail.rfind(b"PK\5\6")
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError(f"{self.path} has no end of central directory")
        n, size, start = struct.unpack("<H2I", tail[at + 10 : at + 20])
        if n == U16 or size == U32 or start == U32:
            sign, _, where, _ = struct.unpack("<4sIQI", self.read(tail_at + at - 20, 20))
            if sign != b"PK\6\7":
                raise ValueError(f"{self.path} has no ZIP64 locator")
            record = self.read(where, 56)
            if record[:4] != b"PK\6\6":
                raise ValueError(f"{self.path} has no ZIP64 end of central directory")
            n, size, start = struct.unpack("<3Q", record[32:56])
        table, at, out = self.read(start, size), 0, {}
        for _ in range(n):
            if table[at : at + 4] != b"PK\1\2":
                raise ValueError(f"{self.path} has a broken central directory")
            method, _, _, crc, packed, real, names, extras, notes = struct.unpack("<3H3I3H", table[at + 10 : at + 34])
            header = int.from_bytes(table[at + 42 : at + 46], "little")
            name = table[at + 46 : at + 46 + names].decode("utf-8", "replace")
            extra = table[at + 46 + names : at + 46 + names + extras]
            while len(extra) >= 4:
                kind, length = struct.unpack("<2H", extra[:4])
                if kind == 1:
                    wide = list(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                    real = wide.pop(0) if real == U32 else real
                    packed = wide.pop(0) if packed == U32 else packed
                    header = wide.pop(0) if header == U32 else header
                extra = extra[4 + length :]
            out[name] = Entry(name, method, crc, packed, real, header)
            at += 46 + names + extras + notes
        return out

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes start, and how many they are."""
        e = self.entries[name]
        if e.method:
            raise ValueError(f"{name} in {self.path} is compressed; only stored members are read by ranges")
        head = self.read(e.header, 30)
        if head[:4] != b"PK\3\4":
            raise ValueError(f"{self.path} has no local header for {name}")
        names, extras = struct.unpack("<2H", head[26:30])
        return e.header + 30 + names + extras, e.size

    def member(self, name: str) -> bytes:
        data = self.read(*self.place(name))
        if zlib.crc32(data) != self.entries[name].crc:
            raise ValueError(f"{name} in {self.path} has a wrong CRC-32")
        return data

    def close(self) -> None:
        self._file.close()


# ---------------------------------------------------------------- WARC


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None, page_id: int | None) -> str:
    """The URL without characters that would break a header."""
    found = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    return found or f"urn:page:{page_id}"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None, date: str = DATE) -> bytes:
    """A WARC record: a response, or a revisit of the response of page ``refers_to``, which keeps the HTTP headers only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}"]
    head += [f"WARC-Target-URI: {_uri(url, page_id)}", f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers by lower-case name, HTTP headers likewise, and the payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size : size + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record has a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("utf-8", "replace").split("\r\n")[1:])}
    return fields, inner, payload


# ---------------------------------------------------------------- writing


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of at least ``least`` bytes, the one with the largest id is the response.

    Digests are counted first. Those that occur more than once are written and, up
    to a counted number, broadcast, so that no payload moves; beyond it both sides
    are dealt out by digest.
    """
    payload = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long"), "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("_sha"), F.octet_length(payload).alias("_size"))
    groups = keyed.filter(F.col("_size") >= least).groupBy("_sha").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
    again = stage_table(groups.filter("_n > 1").select("_sha", "_first"), "again")
    joined = keyed.join(F.broadcast(again) if again.count() <= BROADCAST_DIGESTS else again, "_sha", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("_first")), F.lit(None).cast("long")).otherwise(F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """Write archives of ``page_id, url, html, refers_to``; returns ``path, n_records, n_bytes`` of each.

    A task starts another archive beyond ``archive_bytes``, so its memory is
    bounded. Names hold the task attempt: only archives in the returned table
    count, and those of a lost attempt are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = pafs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        task, seq, at = TaskContext.get(), 0, 0
        data, lines = [], []

        def out() -> pa.RecordBatch:
            nonlocal seq, at
            name = f"pages-{task.partitionId():06d}-{seq:04d}-{task.taskAttemptId()}.wacz"
            about = {"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}], "records": len(lines)}
            members = [(DATA, b"".join(data)), (INDEX, "".join(sorted(lines)).encode()), (PACKAGE, json.dumps(about).encode())]
            size = 0
            with files.open_output_stream(f"{place}/{name}.part") as f:
                for piece in zip_stored(members, zip64):
                    size += f.write(piece)
            files.move(f"{place}/{name}.part", f"{place}/{name}")
            row = pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [len(lines)], "n_bytes": [size]}, pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))
            data.clear(), lines.clear()
            seq, at = seq + 1, 0
            return row

        for b in batches:
            for i in range(b.num_rows):
                page_id, url, html, refers_to = (c[i].as_py() for c in b.columns)
                payload = (html or "").encode()
                digest = payload_digest(payload)
                packer = zlib.compressobj(1, wbits=31)
                packed = packer.compress(record(page_id, url, payload, digest, refers_to)) + packer.flush()
                facts = {"url": _uri(url, page_id), "digest": f"sha1:{digest}", "filename": DATA, "offset": at, "length": len(packed)}
                lines.append(f"{facts['url'].partition('://')[2] or facts['url']} {re.sub('[^0-9]', '', DATE)} {json.dumps(facts)}\n")
                data.append(packed)
                at += len(packed)
                if at >= archive_bytes:
                    yield out()
        if lines:
            yield out()

    return pages.select("page_id", "url", "html", "refers_to").transform(mapped, run, "path string, n_records long, n_bytes long")


# ---------------------------------------------------------------- reading


def index_lines(text: str) -> list[dict]:
    return [json.loads(x.split(" ", 2)[2]) for x in text.splitlines() if x]


def locate(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, size, offsets, lengths``: ranges of whole records in the archives that ``archives`` names by ``path``.

    Directories and indexes are read, records are not. ``start`` counts from the
    start of the archive, ``offsets`` from ``start``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
        for b in batches:
            for path in b.column(0).to_pylist():
                zipped = ZipArchive(path)
                rows = []
                for name in [n for n in zipped.entries if n.startswith("indexes/")]:
                    held: dict[str, list[tuple[int, int]]] = {}
                    for x in index_lines(zipped.member(name).decode()):
                        held.setdefault(x["filename"], []).append((x["offset"], x["length"]))
                    for member, spans in held.items():
                        base, _ = zipped.place(member)
                        spans.sort()
                        first = 0
                        for k in range(1, len(spans) + 1):
                            if k == len(spans) or spans[k][0] + spans[k][1] - spans[first][0] > range_bytes:
                                part = spans[first:k]
                                at = part[0][0]
                                rows.append((path, base + at, part[-1][0] + part[-1][1] - at, [o - at for o, _ in part], [n for _, n in part]))
                                first = k
                zipped.close()
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], schema=kinds)

    return archives.select("path").transform(mapped, run, "path string, start long, size long, offsets array<long>, lengths array<long>")


def read_records(ranges: DataFrame, parts: int) -> DataFrame:
    """The records of ``locate``'s ranges, each range fetched at once, in ``parts`` tasks.

    ``page_id, record_type, uri, payload_bytes, payload_digest, refers_to, payload``:
    the digest of a response is computed again and held against its header; a
    revisit has its digest and size from its headers and a null payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for path, start, size, offsets, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                files, place = pafs.FileSystem.from_uri(path)
                with files.open_input_file(place) as f:
                    f.seek(start)
                    data = f.read(size)
                rows = []
                for o, n in zip(offsets, lengths, strict=True):
                    fields, http, payload = parse_record(zlib.decompress(data[o : o + n], wbits=31))
                    digest, known = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "response"
                    if known and payload_digest(payload) != digest:
                        raise ValueError(f"a payload in {path} does not match its digest")
                    whole = len(payload) if known else int(http["content-length"])
                    ids = [int(x) if (x := fields.get(k)) is not None else None for k in ("warc-page-id", "warc-refers-to-page-id")]
                    rows.append((ids[0], fields["warc-type"], fields.get("warc-target-uri"), whole, digest, ids[1], payload if known else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    dealt = ranges.repartition(parts)
    return dealt.transform(mapped, run, "page_id long, record_type string, uri string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write each row of ``pages`` (``page_id, url, html``) as a record, and read all records back.

    A null ``html`` is an empty payload; a null ``url`` becomes a name made of the
    id; a row without id is archived with a null id, and as revisit only if its
    payload's response has one. Rows that repeat the largest id of a payload are
    all responses. Other columns are ignored; an empty table gives no archive
    and no row.
    """
    folder = stage_path(pages.sparkSession, "archives")
    archives = stage_table(write_archives(with_revisits(pages, least), folder), "archive-list")
    parts = width(pages)
    return read_records(locate(archives.repartition(parts, "path")), parts)
