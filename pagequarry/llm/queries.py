"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, flac, huffman_ids, langid, line_dedup, lm_score, merkle, pii, sentencepiece_viterbi, simhash, spelling, suffix_dedup, warc_zip
from .common import documents


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.without_shared_lines(documents(spark, sf_dir)))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepiece_viterbi.round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.without_repeats(documents(spark, sf_dir)))


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.digests(flac.store(documents(spark, sf_dir)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return huffman_ids.digests(huffman_ids.stored_ids(documents(spark, sf_dir), path))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(documents(spark, sf_dir)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(merkle.manifest(documents(spark, sf_dir), tampered=merkle.tampered_counts()))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_decontaminate": op2_decontaminate,
        "op3_line_dedup": op3_line_dedup,
        "op4_simhash": op4_simhash,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_flac": op7_flac,
        "op8_language_id": op8_language_id,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_token_ids": op10_token_ids,
        "op11_pii": op11_pii,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontaminate": decontaminate.ORACLE_SQL,
        "op3_line_dedup": line_dedup.ORACLE_SQL,
        "op12_merkle_manifest": merkle.ORACLE_SQL,
        "op13_spelling_variants": spelling.ORACLE_SQL,
    }
