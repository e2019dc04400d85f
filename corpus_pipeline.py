"""A corpus made ready for training: each stage filters or rewrites what the one before kept, the last packs it.

``STAGES`` holds ``(name, function)`` in order. A function takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return
the columns of documents. ``run`` writes each stage's result to the shared work folder and reads it back for the next, so
a stage is computed once and an executor that is lost costs only its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cargoloom.llm import mixing, packing, simhash, suffix_dedup, toxicity
from cargoloom.llm.common import give_back_memory, saved, table
from cargoloom.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; the chain is fitted on the labelled among ``docs``."""
    give_back_memory(spark)  # for this and all later stages
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes and more that stand in an earlier document."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to token shares by source, language and topic."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in training sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Trained models, XXH64 fingerprints and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
