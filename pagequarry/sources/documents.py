"""Full texts of documents as files, written page by page."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.numbering import ranked
from . import files


def write_full_text(pages: DataFrame, folder: str, separator: str = "\n") -> DataFrame:
    """``document_id, page, path, start, offset, bytes``: where each page's text stands in its document's files.

    ``pages`` has ``document_id, page, text``. A document is one folder of parts
    that follow each other by name; pages, in order, are dealt out by ranges of
    document and page, so no document is held by one task or as one string, and a
    large one has several parts. ``start`` is the place in the part, ``offset`` in
    the document as a whole. Parts are written beside their place and moved there.
    """
    placed = ranked(pages.select("document_id", "page", F.coalesce("text", F.lit("")).alias("text")), ["page", F.xxhash64("text")], ["document_id"])
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartitionByRange(parts, F.col("document_id").asc_nulls_first(), "place").sortWithinPartitions(F.col("document_id").asc_nulls_first(), "place")
    between = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        from .binary import _placed

        fs, base = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        now, out, path, at = None, None, "", 0

        def close() -> None:
            if out is not None:
                out.close()
                _placed(fs, os.path.join(base, f"{path}.{task.taskAttemptId()}"), os.path.join(base, path))

        for b in batches:
            starts, sizes, paths = [], [], []
            for document, place, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if out is None or document != now:
                    close()
                    name = hashlib.sha256(repr(document).encode()).hexdigest()[:24]
                    now, path, at = document, f"{name}/part-{task.partitionId():06d}", 0
                    fs.create_dir(os.path.join(base, name), recursive=True)
                    out = fs.open_output_stream(os.path.join(base, f"{path}.{task.taskAttemptId()}"))
                data = text.as_py().encode("utf-8", "surrogatepass")
                if place:
                    out.write(between)
                    at += len(between)
                out.write(data)
                starts.append(at)
                sizes.append(len(data))
                paths.append(path)
                at += len(data)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(paths, pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=["document_id", "page", "path", "start", "bytes"])
        close()

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("document_id", "page")}
    index = dealt.select("document_id", "page", "place", "text").mapInArrow(run, f"document_id {kinds['document_id']}, page {kinds['page']}, path string, start long, bytes long")
    index = files.written(index, "text-index")
    ends = index.groupBy("document_id", "path").agg(F.max(F.col("start") + F.col("bytes")).alias("_size"))
    before = Window.partitionBy("document_id").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    shift = ends.select(F.col("path").alias("_path"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return index.join(shift, F.col("path") == F.col("_path")).select("document_id", "page", "path", "start", (F.col("start") + F.col("_shift")).alias("offset"), "bytes")


def read_pages(index: DataFrame, folder: str) -> DataFrame:
    """``index`` with ``text``, read from the files by range."""
    names = [*index.columns, "text"]
    at = [names.index(c) for c in ("path", "start", "bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            texts, now, f = [], None, None
            for path, start, size in zip(*(b.column(k).to_pylist() for k in at), strict=True):
                if path != now:
                    if f is not None:
                        f.close()
                    now, f = path, fs.open_input_file(os.path.join(base, path))
                texts.append(f.read_at(size, start).decode("utf-8", "surrogatepass"))
            if f is not None:
                f.close()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema)
    return index.mapInArrow(run, f"{kinds}, text string")
