"""Writers of what stages hand on: tables, lists, summaries and packages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Text columns with a header; columns not named are left out, arrays are joined by a bar."""
    names = columns or df.columns
    cast = [F.array_join(F.transform(c, lambda x: x.cast("string")), " | ").alias(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).cast("string").alias(c) for c in names]
    df.select(*cast).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(df: DataFrame, path: str) -> None:
    """An object on each line."""
    df.write.mode("overwrite").json(path)


def enveloped(reviews: DataFrame, raw_columns: list[str]) -> DataFrame:
    """Rows as a review with the raw record that it is about."""
    own = [c for c in reviews.columns if c not in raw_columns]
    return reviews.select(F.struct(*own).alias("review"), F.struct(*raw_columns).alias("raw_record"))


def summary(df: DataFrame, keys: list[str], **facts: str) -> DataFrame:
    """One row with the number of rows, counts by key as maps, and facts."""
    counts = [df.groupBy(k).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(k).cast("string"), F.lit("")), "n")))).alias(f"by_{k}")) for k in keys]
    out = df.agg(F.count("*").alias("n_rows"))
    for c in counts:
        out = out.join(c, F.lit(True))
    return out.select("*", *[F.lit(v).alias(k) for k, v in facts.items()])


def write_page_list(pages: DataFrame, path: str, pattern: str = "%03d") -> None:
    pages.select(F.format_string(pattern, "page").alias("value")).write.mode("overwrite").text(path)


def header_only(spark: SparkSession, columns: list[str]) -> DataFrame:
    """An empty table of text columns, in place of an input that is optional."""
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def lineage(frames: dict[str, DataFrame]) -> DataFrame:
    """A row for each frame of a package with its columns and its number of rows."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("sheet"), "n_rows", F.lit(", ".join(df.columns)).alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


def write_package(frames: dict[str, DataFrame], folder: str) -> None:
    """Each frame as a folder of CSV files, and the package's lineage."""
    for name, df in frames.items():
        write_csv(df, f"{folder}/{name}")
    write_csv(lineage(frames), f"{folder}/lineage")


def report(df: DataFrame) -> str:
    """Lines of ``key: value`` of a one-row summary."""
    row = df.first()
    return "\n".join(f"{k}: {json.dumps(v, default=str, sort_keys=True) if isinstance(v, dict) else v}" for k, v in row.asDict().items())
