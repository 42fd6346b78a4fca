"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and returns the columns of ``documents``, the last
one the pieces of packed sequences. ``run`` writes the result of every stage to the shared folder and reads it again, so a lost
executor repeats no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflow.llm.common import read, stored
from cellflow.llm.exact_dedup import keep_one_copy
from cellflow.llm.jaccard import near_duplicates
from cellflow.llm.language import keep_known, learn
from cellflow.llm.packing import pack
from cellflow.llm.pii import mask
from cellflow.llm.queries import byte_vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of which no language is recognised, go."""
    return keep_known(docs, learn(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return keep_one_copy(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join the one with the smallest id stays; documents with a null id have no links."""
    found = near_duplicates(docs)
    dropped = found.where("doc_id <> component_id").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows."""
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, each document beside its lexical neighbours."""
    return pack(docs, *byte_vocabulary())


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL expresses neither the trained network nor the tokenizer; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
