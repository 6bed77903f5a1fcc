"""Shared helpers: tables in the cluster's shared folder, inputs, whole-batch text access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.files import scratch, shared_dir

__all__ = ["documents", "drop_table", "mapped", "shared_dir", "slices", "stage_path", "stage_table", "utf8", "width"]


#: Rows that the JVM hands to Python at once.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches of ``BATCH_ROWS`` rows at most.

    A batch of texts is held by the JVM, in direct buffers between the processes
    and in Python, so Spark's default of 10,000 rows takes much memory. The session
    keeps the setting, since plans read it when they run.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def stage_path(spark: SparkSession, name: str) -> str:
    return scratch(spark, name)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    The table cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove the files of a ``stage_table`` that nothing reads any longer."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bytes of a table's files that a task of an explicit repartitioning gets at most.
PART_BYTES = 128 << 20


def width(table: DataFrame, times: float = 1.0) -> int:
    """Partitions for explicit repartitioning: the session's number, or more if the table is large.

    ``table`` is read from files, whose size its plan knows; for others, where plans
    give an endless size, it is the session's number. ``times`` is how much larger
    the rows are that are dealt out.
    """
    found = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(found, int(size * times) // PART_BYTES + 1) if size < 1 << 60 else found


def utf8(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 bytes of a string column as one buffer, and n + 1 offsets into it.

    A null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    first = int(offsets[0]) if len(offsets) else 0
    return view[first : int(offsets[-1])], offsets - first


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``most`` bytes together; one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def crc32_sql(codes: str) -> str:
    """SQL for the unsigned CRC-32 of a list of bytes, for SQL twins.

    The table of the checksum is linear in the bits of a byte, so eight of its values are enough.
    """
    step = "a >> 8"
    for k in range(8):
        value = 1 << k
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        step = f"xor({step}, ((xor(a, b) >> {k}) & 1) * {value})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step}), 4294967295)"
