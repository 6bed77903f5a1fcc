"""XLSX workbooks whose rows never pass the driver.

Tasks turn ranges of rows into fragments of a sheet, deflated so that they can
follow each other; the driver knows only their sizes and checksums, writes the
headers of a ZIP file (ZIP64 where it is large) and lets streams copy the
fragments behind them.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import ranked
from . import files

SHEET_ROWS = 1_048_576
#: Characters of XML that a task gathers before it writes a fragment.
FRAGMENT = 4 << 20
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_OFFICE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_LARGE = 0xFFFFFFFF


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of CRC-32, bits reflected."""
    out = 0
    for i in range(32):
        if a >> (31 - i) & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, size: int) -> int:
    """The CRC-32 of two strings, one after the other, from theirs and the second's size."""
    shift, square = 1 << 31, 1 << 23
    while size:
        if size & 1:
            shift = _times(shift, square)
        square, size = _times(square, square), size >> 1
    return _times(shift, first) ^ second


def column_name(n: int) -> str:
    out = ""
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def _row(number: int, values: list[str | None], style: str = "") -> str:
    cells = "".join(f'<c r="{column_name(k)}{number}" t="inlineStr"{style}><is><t xml:space="preserve">{escape(v or "")}</t></is></c>' for k, v in enumerate(values, 1))
    return f'<row r="{number}">{cells}</row>'


def _deflated(text: str) -> tuple[bytes, int, int]:
    """Deflated text that more may follow, its CRC-32 and its size."""
    data, z = text.encode("utf-8", "replace"), zlib.compressobj(6, zlib.DEFLATED, -15)
    return z.compress(data) + z.flush(zlib.Z_FULL_FLUSH), zlib.crc32(data), len(data)


#: An empty last block.
_END = b"\x03\x00"


def fragments(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``first, path, crc32, size, packed``: files of deflated rows of sheets, in the order of ``df``; none has rows of two sheets."""
    most = SHEET_ROWS - 1
    texts = df.select(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]).alias("cells")).withColumn("_order", F.monotonically_increasing_id())
    rows = ranked(files.written(texts, "cells"), ["_order"]).select("place", "cells")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()

        def out() -> pa.RecordBatch:
            data, crc, size = _deflated("".join(held))
            path = f"{name}-{first:09d}"
            part = os.path.join(base, f".{path}.{attempt}")
            with fs.open_output_stream(part) as f:
                f.write(data)
            fs.move(part, os.path.join(base, path))
            held.clear()
            return pa.RecordBatch.from_pydict({"first": [first], "path": [f"{folder}/{path}"], "crc32": [crc], "size": [size], "packed": [len(data)]})

        held: list[str] = []
        first, n = 0, 0
        for b in batches:
            for place, cells in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if held and place % most == 0:
                    yield out()
                if not held:
                    first, n = place, 0
                held.append(_row(place % most + 2, cells.as_py()))
                n += len(held[-1])
                if n > FRAGMENT:
                    yield out()
        if held:
            yield out()

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "place").sortWithinPartitions("place")
    return files.written(dealt.mapInArrow(run, "first long, path string, crc32 long, size long, packed long"), "fragments")


class _Zip:
    """A ZIP file written through the session's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.out, self.at, self.entries = files.created(spark, path), 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, pieces: list[tuple[bytes | str, int, int, int]]) -> None:
        """A member of deflated pieces, as bytes or paths, each with its checksum, size and packed size."""
        crc = size = 0
        for _, c, n, _ in pieces:
            crc, size = joined_crc(crc, c, n), size + n
        packed, start, label = sum(p for *_, p in pieces) + len(_END), self.at, name.encode()
        large = size >= _LARGE or packed >= _LARGE
        extra = struct.pack("<HHQQ", 1, 16, size, packed) if large else b""
        sizes = (_LARGE, _LARGE) if large else (packed, size)
        self._put(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45 if large else 20, 0x800, 8, 0, 33, crc, *sizes, len(label), len(extra)) + label + extra)
        for piece, _, _, n in pieces:
            if isinstance(piece, bytes):
                self._put(piece)
            else:
                files.copied_into(self.spark, piece, self.out)
                self.at += n
        self._put(_END)
        self.entries.append((label, crc, size, packed, start))

    def close(self) -> None:
        start = self.at
        for label, crc, size, packed, at in self.entries:
            wide = [v for v in (size, packed, at) if v >= _LARGE]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            p, s, a = (min(v, _LARGE) for v in (packed, size, at))
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45 if wide else 20, 0x800, 8, 0, 33, crc, p, s, len(label), len(extra), 0, 0, 0, 0, a) + label + extra)
        size, n = self.at - start, len(self.entries)
        if start >= _LARGE or self.at >= _LARGE:
            end = self.at
            self._put(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, start) + struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        self._put(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, min(size, _LARGE), min(start, _LARGE), 0))
        self.out.close()


def write_workbook(frames: dict[str, DataFrame], path: str, widest: int = 60, further: bool = False) -> None:
    """An XLSX workbook with a sheet for each frame: bold header, first row frozen, filters, widths up to ``widest``.

    A frame of more rows than a sheet can hold raises, or with ``further`` goes on
    in sheets of its own after the first, each with the header; a defined name says
    which one they continue. Rows keep their order.
    """
    spark, most = next(iter(frames.values())).sparkSession, SHEET_ROWS - 1
    folder = files.scratch(spark, "workbook")
    made, sheets, continued = [], [], {}
    for f, (name, df) in enumerate(frames.items(), 1):
        names = df.columns
        longest = [F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0)).alias(f"w{i}") for i, c in enumerate(names)]
        count, *widths = df.agg(F.count(F.lit(1)).alias("n"), *longest).first()
        if count > most and not further:
            raise ValueError(f"{name} has more rows than a sheet holds")
        cols = "".join(f'<col min="{i}" max="{i}" width="{min(max(w, len(c)) + 2, widest)}" customWidth="1"/>' for i, (w, c) in enumerate(zip(widths, names, strict=True), 1))
        view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
        head = f'{_HEAD}<worksheet xmlns="{_MAIN}">{view}<cols>{cols}</cols><sheetData>{_row(1, names, chr(32) + "s=" + chr(34) + "1" + chr(34))}'
        # a hundred bytes for some megabytes of rows
        found, start = fragments(df, folder, f"sheet{f}").orderBy("first").collect(), len(sheets) + 1
        for part in range(max(1, -(-count // most))):
            k = start + part
            tail = f'</sheetData><autoFilter ref="A1:{column_name(len(names))}{min(count - part * most, most) + 1}"/></worksheet>'
            pieces = [(r["path"], r["crc32"], r["size"], r["packed"]) for r in found if r["first"] // most == part]
            made.append((f"xl/worksheets/sheet{k}.xml", [_piece(head), *pieces, _piece(tail)]))
            label = f" ({part + 1})" if part else ""
            sheets.append((k, name[: 31 - len(label)] + label))
            if part:
                continued[k] = start
    if len({n.lower() for _, n in sheets}) < len(sheets):
        raise ValueError("two sheets have the same name")
    told = "".join(f'<definedName name="continued_{k}" hidden="1">{n}</definedName>' for k, n in continued.items())
    texts = {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        + f'<Override PartName="/xl/workbook.xml" ContentType="{_OFFICE}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_OFFICE}.styles+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{_OFFICE}.worksheet+xml"/>' for k, _ in sheets)
        + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>' + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in sheets) + "</sheets>" + (f"<definedNames>{told}</definedNames>" if told else "") + "</workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{_RELS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k, _ in sheets) + f'<Relationship Id="rId{len(sheets) + 1}" Type="{_RELS}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
    }
    out = _Zip(spark, f"{path}.partial")
    for name, text in texts.items():
        out.add(name, [_piece(text if name.startswith("[") else f"{_HEAD}{text}")])
    for name, pieces in made:
        out.add(name, pieces)
    out.close()
    files.move(spark, f"{path}.partial", path)
    files.delete(spark, folder)


def _piece(text: str) -> tuple[bytes, int, int, int]:
    data, crc, size = _deflated(text)
    return data, crc, size, len(data)


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """``sheet, row_no, cells`` of an XLSX workbook with texts in its cells, as ``write_workbook`` makes it.

    A frame that goes on in further sheets comes as one, with one header. A sheet
    is read by one task, as a stream, since it is one deflated one.
    """
    most = SHEET_ROWS - 1

    def opened():
        import zipfile

        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(path)
        return zipfile.ZipFile(fs.open_input_file(base))

    def names(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xml.etree import ElementTree

        with opened() as z:
            book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        found = [s.get("name") for s in book.iter(f"{{{_MAIN}}}sheet")]
        marks = {d.get("name"): d.text for d in book.iter(f"{{{_MAIN}}}definedName")}
        start = [int(marks.get(f"continued_{k}", k)) for k in range(1, len(found) + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([found[k - 1] for k in start], pa.string()), pa.array(range(1, len(found) + 1), pa.int32()), pa.array(start, pa.int32())], names=["sheet", "k", "start"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xml.etree import ElementTree

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name] * len(numbers), pa.string()), pa.array(numbers, pa.int32()), pa.array(cells, pa.list_(pa.string()))], names=["sheet", "row_no", "cells"])

        for b in batches:
            for name, k, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                numbers: list[int] = []
                cells: list[list[str]] = []
                with opened() as z, z.open(f"xl/worksheets/sheet{k}.xml") as sheet:
                    above = None
                    for event, e in ElementTree.iterparse(sheet, events=("start", "end")):
                        if e.tag == f"{{{_MAIN}}}sheetData" and event == "start":
                            above = e
                        if e.tag != f"{{{_MAIN}}}row" or event == "start":
                            continue
                        if k == start or int(e.get("r")) > 1:
                            numbers.append(int(e.get("r")) + (k - start) * most)
                            cells.append(["".join(c.itertext()) for c in e.iter(f"{{{_MAIN}}}c")])
                        above.clear()
                        if len(numbers) >= 5000:
                            yield batch()
                            numbers, cells = [], []
                yield batch()

    found = spark.range(1, numPartitions=1).mapInArrow(names, "sheet string, k int, start int").collect()
    sheets = spark.createDataFrame(found, "sheet string, k int, start int").repartition(max(1, len(found)), "k")
    return sheets.mapInArrow(rows, "sheet string, row_no int, cells array<string>")
