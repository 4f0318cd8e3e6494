"""A corpus from raw documents to shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns as Parquet in the
shared folder and reads it again for the next one.  All but the last return the columns of ``documents``; other columns are
dropped, so clashing names do no harm.  An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontam, fertility, jaccard_join, mixing, queries, sharding
from clickloom.llm.deploy import ready
from clickloom.session import pin, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands of their language and length.

    Null and empty texts have no words and go; a null language is compared by script; repeated rows are judged alike.
    """
    ready(spark)
    with small_batches(spark):
        found = pin(queries.measured(docs.select(*COLUMNS)), "pipeline-measured")
    judged = fertility.verdict(found, fertility.bands(found))
    return judged.filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the least id, null ids last, then by the md5 of the text.

    Null counts as the empty text; texts without words are duplicates of equal texts only; of rows equal in all columns one stays.
    """
    ready(spark)
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, over their whole texts.

    Null and empty texts and items contain nothing; repeated rows and null ids are kept or go one by one; an empty benchmark removes nothing.
    """
    return decontam.without_leaks(docs.select(*COLUMNS), ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of the sources takes it (0 to 3).

    A null source is one of its own, the last; texts without words have size 0 and come as often as their hash says; rows that
    repeat an id are taken alike, as are those with a null id.
    """
    return mixing.take(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in 40 shards of nearly equal bytes, equal texts together: doc_id, source, lang, size, shard, slot, text.

    Null texts are a group with 16 bytes a row; rows of one text are numbered by id, null first, rows equal in both in any order.
    """
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long")
    sized = docs.select(*COLUMNS, size.alias("size"), sharding.group_key(F.col("text")).alias("group_key"))
    keys = pin(sized.select("group_key", "size"), "pipeline-sizes")
    placed = sharding.assign_shards(sized, queries.SHARDS, "group_key", "size", sizes=keys)
    return (sharding.with_slots(placed, "shard", ["group_key", "doc_id"])
            .select("doc_id", "source", "lang", "size", "shard", "slot", "text"))


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination),
          ("mixing_sources", mixture), ("sharding", shards)]

#: The stages hash, tokenise and compare in ways SQL cannot express; ``tests/llm`` holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
