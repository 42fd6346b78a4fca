"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellflow.llm.alignment import aligned
from cellflow.llm.ann import nearest
from cellflow.llm.common import read
from cellflow.llm.exact_dedup import exact_dedup
from cellflow.llm.html import extract_text
from cellflow.llm.jaccard import near_duplicates
from cellflow.llm.language import identify, learn
from cellflow.llm.line_dedup import line_dedup
from cellflow.llm.mixing import mix
from cellflow.llm.negatives import hard_negatives
from cellflow.llm.packing import pack
from cellflow.llm.pieces import encode_decode
from cellflow.llm.pii import BASE, find_personal_data
from cellflow.llm.shards import materialise

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


def byte_vocabulary() -> tuple[str, str]:
    """Where the ranks of the byte-level vocabulary are, and its pattern."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_personal_data(spark, folder):
    rows = find_personal_data(read(spark, folder, "documents").select("doc_id", "text"))
    found = F.coalesce(F.col("found"), F.array().cast(rows.schema["found"].dataType))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind))
    counts = [of_kind(k).cast("bigint").alias(f"n_{k}") for k in BASE]
    return rows.select(
        "doc_id", *counts,
        F.sha2(shown(F.filter(found, lambda s: s["kind"].isin(list(BASE)))).cast("binary"), 256).alias("base_sha256"),
        shown(found).alias("spans"))


@query
def op2_language(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    return identify(docs, learn(docs))


@query
def op3_jaccard_join(spark, folder):
    return near_duplicates(read(spark, folder, "documents"))


@query
def op4_nearest_vectors(spark, folder):
    return nearest(read(spark, folder, "embeddings"), "vec_id % 50 = 0")


@query
def op5_training_order(spark, folder):
    return materialise(read(spark, folder, "documents"), *byte_vocabulary())


@query
def op6_exact_dedup(spark, folder):
    return exact_dedup(read(spark, folder, "documents"))


@query
def op7_main_text(spark, folder):
    return extract_text(read(spark, folder, "pages"))


@query
def op8_pieces(spark, folder):
    rows = encode_decode(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op9_line_dedup(spark, folder):
    rows = line_dedup(read(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query
def op10_packing(spark, folder):
    return pack(read(spark, folder, "documents"), *byte_vocabulary())


@query
def op11_mixing(spark, folder):
    return mix(read(spark, folder, "documents"))


@query
def op12_hard_negatives(spark, folder):
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(read(spark, folder, "embeddings"), "vec_id % 50 = 0", label)


@query
def op13_token_alignment(spark, folder):
    rows = aligned(read(spark, folder, "documents"), *byte_vocabulary(), public_tokenizers.path("piece_bpe_32k.model"), hashed=True)
    return rows.withColumnRenamed("groups", "groups_sha256")
