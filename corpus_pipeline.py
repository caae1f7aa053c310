"""The corpus pipeline: toxic documents out, near copies out, repeated passages out, benchmark leaks out, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet below the
shared scratch folder and read again as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakesmith.llm import bpe, decontaminate, simhash, substrings, toxicity
from lakesmith.llm.common import staged
from lakesmith.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the rows of ``docs`` with labels; documents that score 0.3 or more go."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """3-word shingles, links at 2 or fewer bits; of each group the document with the smallest id stays."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by 13-word windows of documents with smaller ids go; their documents stay."""
    return substrings.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is left."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substrings", cut_repeats),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: Learning, fingerprints and alignment have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
