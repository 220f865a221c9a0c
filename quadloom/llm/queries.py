"""Registered queries of the dealt operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.llm import (
    codes,
    conversations,
    counts,
    divergence,
    mixing,
    neighbours,
    packing,
    pieces,
    quality,
    repetition,
    sharding,
    simhash,
    substrings,
)
from quadloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sentencepiece(spark, sf_dir):
    return pieces.digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_token_counts(spark, sf_dir):
    return counts.over_limits(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_token_codes(spark, sf_dir):
    return codes.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.digests(documents(spark, sf_dir))


@query
def op4_repetition(spark, sf_dir):
    return repetition.judged(documents(spark, sf_dir))


@query
def op8_sharding(spark, sf_dir):
    return sharding.digests(documents(spark, sf_dir))


@query
def op10_learned_partitions(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.search(vectors, F.col("vec_id") % 50 == 0)


@query
def op6_ordinal_quality(spark, sf_dir):
    return quality.digests(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op3_raked_mixing(spark, sf_dir):
    return mixing.digests(documents(spark, sf_dir))


ORACLES["op3_raked_mixing"] = mixing.oracle()


@query
def op5_substring_dedup(spark, sf_dir):
    return substrings.digests(documents(spark, sf_dir))


@query
def op13_packing(spark, sf_dir):
    return packing.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_conversation_repair(spark, sf_dir):
    return conversations.digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(documents(spark, sf_dir))


ORACLES["op11_source_divergence"] = divergence.ORACLE
