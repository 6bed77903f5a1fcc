"""Resumable ingestion: a folder of OCR page files as a stream that runs until it has seen all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import parsed_ocr_pages


def page_stream(spark: SparkSession, folder: str, files: int = 1000, names: str = "page_*.json", whole: bool = True) -> DataFrame:
    """Lines of the OCR page files of a folder as a stream; files seen before are not read again.

    A file is a page, or has one on each line if ``whole`` is false.
    """
    texts = spark.readStream.option("pathGlobFilter", names).option("maxFilesPerTrigger", files).text(folder, wholetext=whole)
    return parsed_ocr_pages(texts)


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, **options) -> None:
    """Append the lines of all new page files to a Parquet table and stop; a rerun takes up where the last one ended."""
    query = page_stream(spark, folder, **options).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
