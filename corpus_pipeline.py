"""A training corpus from documents: five stages, each calling one of the operators.

Each stage takes (spark, docs, sf_dir); ``run`` writes what a stage returns and
reads it again for the next one. All but the last return the columns of
documents; the last adds token ids and the text that they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.llm import mixing, pieces, quality, simhash, substrings
from quadloom.llm.common import checkpointed, documents


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, learned from labels, grades highest."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints: shingles of four words, at most four bits apart."""
    return simhash.one_of_component(docs, words=4, radius=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that are earlier in the corpus; n_chars follows the text."""
    return substrings.removed(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics are raked to their target weights."""
    return mixing.mixed(docs, mixing.Plan(rate=0.95))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, and the text that these decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(docs, model).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("accept_quality", accept_quality),
    ("drop_near_copies", drop_near_copies),
    ("drop_repeats", drop_repeats),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

# A learned classifier, fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
