"""Readers of page files by name, as data sources of Spark.

A reader is a function from the text of a page file to rows. Registered under a
name, it is a format for ``spark.read``: files are dealt into partitions by size, a
filter on ``page`` leaves out files by their names before any is opened, and files
that the function refuses are left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

#: Gives rows, or batches of rows with the columns of its schema.
Parser = Callable[[int, str], Iterable[tuple | pa.RecordBatch]]
#: Bytes of files that a partition gets at most, but for a larger file.
PART_BYTES = 32 << 20
#: Rows of a batch that a reader gives at once.
BATCH_ROWS = 10_000
_PAGE = re.compile(r"page[_-]?0*(\d+)")
READERS: dict[str, tuple[Parser, str]] = {}


class Files(InputPartition):
    def __init__(self, files: list[tuple[int, str]]):
        super().__init__(files)
        self.files = files


class PageReader(DataSourceReader):
    """Reads the page files of a folder with a parser."""

    def __init__(self, options: dict[str, str], parse: Parser):
        self.folder, self.part_bytes, self.parse = options["path"], int(options.get("partBytes", PART_BYTES)), parse
        self.pages: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == ("page",):
                wanted = set(f.value) if isinstance(f, In) else {f.value}
                self.pages = wanted if self.pages is None else self.pages & wanted
            # rows are looked at again, since a file may say another page than its name
            yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(self.folder)
        found = []
        for info in fs.get_file_info(pafs.FileSelector(base, recursive=False)):
            named = _PAGE.search(info.base_name)
            if info.is_file and named and not info.base_name.startswith(".") and (self.pages is None or int(named[1]) in self.pages):
                found.append((int(named[1]), info.path, info.size))
        parts, size = [], self.part_bytes
        for page, path, n in sorted(found):
            if size + n > self.part_bytes:
                parts.append([])
                size = 0
            parts[-1].append((page, path))
            size += n
        return [Files(p) for p in parts] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple | pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, _ = pafs.FileSystem.from_uri(self.folder)
        for page, path in partition.files:
            with fs.open_input_stream(path) as f:
                data = f.read()
            try:
                rows = list(self.parse(page, data.decode()))
            except (ValueError, KeyError, TypeError, AttributeError):
                continue
            yield from rows


def reader(name: str, schema: str) -> Callable[[Parser], Parser]:
    """Register a function of a page number and a file's text, which gives rows of ``schema``, as the reader ``name``."""

    def add(parse: Parser) -> Parser:
        READERS[name] = (parse, schema)
        return parse

    return add


def source(reader_name: str) -> type[DataSource]:
    """The data source of a registered reader."""
    given, columns = READERS[reader_name]

    class PageFiles(DataSource):
        @classmethod
        def name(cls) -> str:
            return reader_name

        def schema(self) -> str:
            return columns

        def reader(self, schema: Any) -> PageReader:
            return PageReader(self.options, given)

    return PageFiles


def use(spark: SparkSession, name: str) -> str:
    """Make a reader a format of the session; returns its name."""
    if name not in READERS:
        raise KeyError(f"there is no reader {name}")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source(name))
    return name


def read_tables(spark: SparkSession, folder: str, names: tuple[str, ...] = ("own_tables",)) -> DataFrame:
    """Tables of page files: by the first of ``names`` that is registered, else the delimited tables of their text.

    The latter are those of ``text_tables``.
    """
    from ..operators.pages import text_tables

    for n in names:
        if n in READERS:
            return spark.read.format(use(spark, n)).load(folder)
    texts = spark.read.option("pathGlobFilter", "page_*").text(folder, wholetext=True)
    page = F.regexp_extract(F.col("_metadata.file_name"), _PAGE.pattern, 1).cast("int")
    return text_tables(texts.select(page.alias("page"), F.col("value").alias("text")))


OCR_LINE = pa.schema(
    [("document_id", pa.string()), ("page", pa.int32()), ("table_index", pa.int32()), ("line_no", pa.int32()), ("text", pa.string())]
    + [(c, pa.float64()) for c in ("confidence", "x1", "y1", "x2", "y2")]
    + [("source_kind", pa.string())]
)


@reader("ocr_page_lines", "document_id string, page int, table_index int, line_no int, text string, confidence double, x1 double, y1 double, x2 double, y2 double, source_kind string")
def ocr_page_lines(_: int, text: str) -> Iterator[pa.RecordBatch]:
    """The lines of an OCR page file, which names its page itself."""
    data = json.loads(text)
    page = int(data["page"])
    number = lambda v: None if v is None else float(v)
    rows = (
        (data.get("document_id"), page, table.get("table_index", k), n, line.get("text"), number(line.get("confidence")), *(number(b.get(s)) for s in ("x1", "y1", "x2", "y2")), line.get("source_kind"))
        for k, table in enumerate(data.get("tables") or [])
        for n, line in enumerate(table.get("lines") or [])
        for b in (line.get("bbox") or {},)
    )
    # columns at once, not values of rows one by one; a page of any number of lines is some batches
    while some := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), OCR_LINE.types, strict=True)], schema=OCR_LINE)
