"""One registered query per operator, and the pipeline: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bisector,
    chat,
    decontam,
    fertility,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    packing,
    sharding,
    simhash,
    vocabularies,
    warc,
)
from clickloom.llm.deploy import ready
from clickloom.llm.oracles import ORACLES
from clickloom.session import pin, small_batches

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(warc.with_revisits(table(spark, sf_dir, "pages")))
    return warc.read_warc(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.run_report(table(spark, sf_dir, "documents"))


def op7_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.turns_in_order(table(spark, sf_dir, "conversations"))
    rendered = chat.renderings(chat.perspectives(turns))
    return chat.rendering_digests(rendered).withColumnRenamed("conv", "conv_id")


def op8_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabularies.default_path("byte_bpe_50k.json")
    return packing.read_ids(packing.write_ids(table(spark, sf_dir, "documents"), path))


def measured(docs: DataFrame) -> DataFrame:
    return fertility.measure(docs, vocabularies.default_path("byte_bpe_50k.tiktoken"),
                             vocabularies.default_path("piece_bpe_32k.model"))


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    with small_batches(spark):
        found = pin(measured(docs).drop("text"), "fertility")
    judged = fertility.verdict(found, fertility.bands(found))
    return judged.select("doc_id", *fertility.COUNTS, "base_failed", "kept", *fertility.MEASURES)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        sharding.group_key(F.col("text")).alias("group_key"))
    docs = pin(docs, "shard-sizes")
    placed = sharding.assign_shards(docs, SHARDS, "group_key", "size")
    placed = sharding.with_slots(placed, "shard", ["group_key", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.select("doc_id", "n_features", "weight", "score", "rank")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_bisector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixing, op2_decontamination, op3_jaccard_join, op4_warc, op5_language_id, op6_line_dedup,
                            op7_chat_perspectives, op8_packed_ids, op9_fertility, op10_sharding, op11_importance, op12_simhash,
                            op13_bisector, pipeline)}

__all__ = ["ORACLES", "QUERIES"]
