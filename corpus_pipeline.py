"""The corpus pipeline: five stages over ``documents``, each by one operator of ``tickworks.llm``.

Each stage takes what its predecessor kept and returns the columns of documents; the
last one returns the encoded documents. Between stages a table is written as Parquet
and read back. Order: quality classifier (rejected documents go), line dedup
(recurring templates go from all documents but their first), n-gram Jaccard join (of
each component the smallest id stays), mixing (documents repeat as often as they
are taken; those not taken go), BPE encoding and decoding.

Nulls, empty tables, repeated rows and extra columns: as the operators state. A
document whose every line recurs elsewhere stays, with what is left of its text;
``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickworks.llm import bpe, line_templates, mixing, ngram_join, quality_cnn
from tickworks.llm.common import stored, table
from tickworks.llm.queries import tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_cnn.accepted(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring_lines(docs).drop("_n_lines", "_n_dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", join_stage),
    ("mixing", mix_stage),
    ("bpe", bpe_stage),
]

#: A convolutional network, random rounding and BPE merges have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
