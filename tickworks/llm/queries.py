"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, edit_embedding, lbl_model, line_templates, merkle, mixing, ngram_join, quality_cnn, shards, spelling,
               token_files, topk, warc)
from .common import table


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; every operator takes a path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), min_bytes=0).drop("url")


def op2_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.classed_fingerprints(table(spark, sf_dir, "documents"))


def op3_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), with_ids=False)


def op5_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.document_lines(table(spark, sf_dir, "documents"))


def op7_lbl_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl_model.scores(table(spark, sf_dir, "documents"))


def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_leaves(table(spark, sf_dir, "documents"))


def op13_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_warc, op2_edit_fingerprints, op3_pivotal_mix, op4_word_bpe, op5_histogram_top_k, op6_line_templates,
        op7_lbl_scores, op8_quality_cnn, op9_ngram_jaccard, op10_token_files, op11_spelling_variants,
        op12_merkle_manifest, op13_uniform_shards)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.pages_sql(), "op5_histogram_top_k": topk.ORACLE_SQL, "op6_line_templates": line_templates.ORACLE_SQL,
            "op9_ngram_jaccard": ngram_join.ORACLE_SQL, "op11_spelling_variants": spelling.ORACLE_SQL,
            "op12_merkle_manifest": merkle.ORACLE_SQL}
