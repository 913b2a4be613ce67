"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm import (
    digests, embeddings, mixing, negatives, packing, pages, pii, sharding, simhash, tokenbin, toxicity, trie, warc)
from cohortix.llm.common import filled, table
from cohortix.llm.oracles import ORACLES
from cohortix.session import shared_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_END = 2
WORD_END = 1
SHARDS = 8

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}


def query(build: Query) -> Query:
    _registered[build.__name__] = build
    return build


def llm_queries() -> dict[str, Query]:
    return dict(_registered)


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)


def crc(c: str):
    return F.crc32(F.col(c))


@query
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/cohortix/tokens-{uuid.uuid4().hex}"
    tokenbin.write_tokens(table(spark, sf_dir, "documents"), path, BYTE_BPE, end_id=BYTE_END)
    return tokenbin.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", crc("ids").alias("ids_crc32"))


@query
def op3_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = filled("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", text.alias("text")).withColumns({
            "size": (F.octet_length("text") + 1).cast("long"), "text_crc32": F.crc32(F.encode("text", "UTF-8")),
            "hash": F.xxhash64("text")}).drop("text")
    return sharding.interleave(docs, SHARDS, text_col="hash").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=WORD_END)
    return pieces.select("doc_id", "start", "length", crc("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, draws = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(documents, draws).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), count_col="n_values").select("doc_id", "text", "n_values")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs, model, "text", "score").select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op9_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = trie.paths(table(spark, sf_dir, "conversations"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    return trie.prefix_trie(trie.grafted(own, F.col("conv_id") - F.col("conv_id") % 5, heads, 8))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/cohortix/warc-{uuid.uuid4().hex}"
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.captures(warc.read_records(spark, path, payloads=False)))

    def page(metadata: str):
        return F.get_json_object(F.element_at(F.col(metadata), 1)["fields"].cast("string"), "$.page_id").cast("long")

    return found.select(
        page("metadata").alias("page_id"),
        F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        page("original.metadata").alias("refers_to"))
