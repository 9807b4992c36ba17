"""A corpus pipeline from raw documents to tokens: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fonolith.llm.bpe import encode_documents
from fonolith.llm.common import materialize
from fonolith.llm.line_dedup import clean_documents
from fonolith.llm.minhash import drop_near_copies
from fonolith.llm.mixing import mix_documents
from fonolith.llm.quality_rules import filter_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; all documents stay, also with an empty text, and n_chars follows the text."""
    return clean_documents(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest doc_id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it: not at all, once or twice."""
    return mix_documents(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of each row."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding", bpe_encode),
]

#: SQL can't express MinHash, pivotal rounding and BPE; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
