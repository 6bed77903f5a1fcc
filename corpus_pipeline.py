"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import decontaminate, langid, line_dedup, sentencepiece_viterbi, simhash
from pagequarry.llm.common import documents, stage_table

def _as(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``kept`` with the columns of ``docs``, in their order."""
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a letter, which have a language; texts that are null, blank or only marks go."""
    return _as(docs, langid.with_language(docs))


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that many sites share out of the texts; no document goes. ``n_chars``, where there is one, follows."""
    added = {"n_lines", "n_removed"} & set(docs.columns)
    rows = docs
    for c in added:
        rows = rows.withColumnRenamed(c, f"_own_{c}")
    kept = line_dedup.without_shared_lines(rows)
    for c in added:
        kept = kept.drop(c).withColumnRenamed(f"_own_{c}", c)
    return _as(docs, kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts, that of the least id.

    Rows of one id and different texts are different documents; a row that repeats
    in id and text stays once; rows without an id stay.
    """
    groups = stage_table(simhash.similar_texts(docs), "groups")
    keep = groups.filter("doc_id = component_id and print = component_print").groupBy("doc_id", "print").count()
    again = not keep.filter("count > 1").isEmpty()
    # a struct, so that no column of the table can clash with those added here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long"), simhash.text_print(F.col("text")).alias("print"))
    named = rows.filter("doc_id is not null").join(keep.select("doc_id", "print"), ["doc_id", "print"], "left_semi")
    named = named.dropDuplicates(["doc_id", "print"]) if again else named
    return named.unionByName(rows.filter("doc_id is null")).select("_row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of ``benchmark``."""
    return _as(docs, decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes what is left."""
    import public_tokenizers

    return sentencepiece_viterbi.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", boilerplate),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("sentencepiece", pieces),
]

#: A trained network decides the first stage, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
