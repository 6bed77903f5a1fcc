"""Files and folders that the driver and all executors share, through Spark's own file systems."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pagequarry-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str = "scratch") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def tidy_up(spark: SparkSession) -> None:
    """Let shuffle files go that no plan needs any more; else they stay until the driver collects its garbage by itself."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a table in the shared folder, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file whole or not at all."""
    put_bytes(spark, path, text.encode())


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file beside its place and move it there, so that no reader sees half of it."""
    p, fs = _at(spark, path)
    part, _ = _at(spark, f"{path}.partial")
    out = fs.create(part, True)
    try:
        out.write(data)
    finally:
        out.close()
    move(spark, f"{path}.partial", path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file over another one, or to where none is, in one step, so that there is a whole file at any time."""
    part, fs = _at(spark, source)
    p, _ = _at(spark, target)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(fs.makeQualified(part), fs.makeQualified(p), over)


def created(spark: SparkSession, path: str):
    """A stream of the session's file system to a new file."""
    p, fs = _at(spark, path)
    return fs.create(p, True)


def copied_into(spark: SparkSession, path: str, out) -> None:
    """Copy a file into a stream, without its bytes passing Python."""
    p, fs = _at(spark, path)
    source = fs.open(p)
    try:
        spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
    finally:
        source.close()


def get_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return spark.read.text(path, wholetext=True).first()["value"]


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file or a folder, over what is there."""
    a, fs_a = _at(spark, source)
    b, fs_b = _at(spark, target)
    if fs_b.exists(b):
        fs_b.delete(b, True)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_a, a, fs_b, b, False, conf):
        raise OSError(f"cannot copy {source}")
