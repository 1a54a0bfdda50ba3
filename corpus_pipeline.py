"""A training corpus from documents, in five stages.

Toxic documents go; of each group of near copies one document stays; passages that an earlier
document has are cut out; documents that hold benchmark passages go; what is left becomes
SentencePiece ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from accessaudit.llm import contamination, pieces, repeats, simhash, toxicity
from accessaudit.llm.common import importable, read_table
from accessaudit.session import fresh_folder, written


@importable
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


@importable
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


@importable
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs)


@importable
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


@importable
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("pieces", encode_pieces),
]

#: A fitted classifier, components and pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = fresh_folder(spark, "pipeline")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = written(docs, f"{folder}/{name}")
    return docs
