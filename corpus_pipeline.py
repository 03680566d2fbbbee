"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

A stage takes and returns the columns of the documents it is given, with their
values and types, whatever they are called; the last one adds tokens. Null ids and texts, repeated rows and further columns are handled as
the operators state. Stages store what they compute in the cluster's shared
folder, so a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm import bpe, mixing, neardup, quality
from keyfold.llm.common import table
from keyfold.storage import store

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    rated, _ = quality.rate_documents(_with_row(docs, "text"), keep=["given_row"])
    return rated.filter("kept").select("given_row.*")


def _with_row(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns that a stage reads, and the given row as one column that it only carries."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given_row")
    return docs.select(row, *columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id."""
    return neardup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: each document as often as it is taken."""
    mixed = mixing.mix_sources(_with_row(docs, "doc_id", "text", "source"), keep=["given_row"])
    return mixing.take_copies(mixed, ["given_row"]).select("given_row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with ``n_tokens`` and ``ids``, which replace given columns of these names."""
    return bpe.encode_documents(docs, TOKENIZER, bpe.build_lexicon(docs, TOKENIZER))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix),
    ("bpe", tokenize),
]

# Expectation-maximisation, signatures and merges have no SQL; the tests compare
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
