"""The registered query of each operator: production parameters, whole tables, whole results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.llm import alignment, dialogue, hnsw, languages, mixing, packing, quality_crf, sharding, simhash, suffix_dedup, syncmers, token_files, toxicity
from cargoloom.llm.common import Query, table
from cargoloom.session import new_work_path

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_work_path(spark, "token-files")
    parts = token_files.write_token_files(table(spark, sf, "documents"), folder, tokenizer("byte_bpe_50k.json"))
    return token_files.read_token_files(parts, folder)


@query
def op5_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.place(table(spark, sf, "documents"), SHARDS)
    written = sharding.write_shards(placed, new_work_path(spark, "shards"))
    return written.select("doc_id", "slot", "shard", "shard_name")


@query
def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality_crf.score(docs, quality_crf.fit(docs, table(spark, sf, "labels")))


@query
def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query
def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept")


@query
def op9_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf, "documents"))


@query
def op3_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query
def op12_languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return languages.predict(docs, languages.fit(docs))


@query
def op13_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    return dialogue.repair(dialogue.damaged(table(spark, sf, "conversations")))
