"""A training corpus from `documents` in stages; each stage works on all its predecessor kept.

language    documents in no known language go; `lang` becomes the identified language
site lines  boilerplate lines of a source leave the texts
near dups   one document of each group of near duplicates stays
mixing      sources are brought to their target weights; documents are dropped, repeated or cut
tokens      texts become ids, and ids texts again as a check
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from noticeloom.llm import byte_bpe, language, minhash, mixing, site_lines
from noticeloom.llm.common import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Stages drop documents and cut texts by models and hashes that SQL does not have.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification keeps, with the language it found.

    Null and empty texts have no language and go; null ids, languages and sources are judged as others.
    """
    found = language.identify(docs.select(*COLUMNS), keep=("text", "source", "n_chars")).filter("kept")
    return found.withColumnRenamed("language", "lang").select(*COLUMNS)


def without_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; a null source is one of its own."""
    return _counted(site_lines.drop_site_lines(docs.select(*COLUMNS), "source", "text"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words, or with null text, stay."""
    return minhash.drop_near_duplicates(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per drawn document; what has no words is never drawn, a null source is one of its own."""
    return _counted(mixing.mixed_documents(docs.select(*COLUMNS), COLUMNS))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256) of every document."""
    decoded = byte_bpe.encode_and_decode(
        docs.select("doc_id", "lang", "source", "text"), RANKS, public_tokenizers.PATTERN)
    return byte_bpe.with_digests(decoded).select(
        "doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("site_lines", without_site_lines),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("byte_bpe", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
