"""The training-data pipeline: stages on `documents`, each written and read again by the next.

Judged on its own input, each stage keeps every row but those it exists to remove: texts that no
learned language claims go, later copies of repeated line runs are cut out of texts, of near-duplicates one stays,
the mix takes each source up to its target, and the last stage encodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import base, bpe, langid, linededup, minhash, mixing
from tidemark.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the model takes for one of the languages that it has learned."""
    return langid.confident(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more."""
    return linededup.dedup(docs).drop("n_lines", "n_removed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return minhash.first_of_groups(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of ids and decoded text."""
    return bpe.encode(docs, tokenizer_path()).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's rows written as Parquet and read again."""
    scratch = base.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs


#: Language models, signatures and byte-pair merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
