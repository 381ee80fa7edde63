"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, mixture and shards, each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontamination, mixing, sharding, toxicity
from clickloom.llm.common import require, stored
from clickloom.llm.jaccard_join import jaccard_join

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3; what to learn comes from the labels of documents that are still there."""
    scored = toxicity.score(docs.select(COLUMNS), require(spark, sf_dir, "labels"))
    return scored.where("score < 0.3").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word shingles link at 0.8 or more, one: that with the smallest doc_id, null last, then by the hash of its text.

    Documents without words stay. Which rows are one document is told by doc_id and text, so repeated or null ids do no harm.
    """
    docs = docs.select(COLUMNS)
    groups = stored(jaccard_join(docs, k=5, percent=80), "groups")
    some = groups.where("n_shingles > 0")
    first = some.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f"), F.count("*").alias("n"))
    keep = first.select("f.doc_id", "f.key").unionByName(groups.where("n_shingles = 0").select("doc_id", "key").distinct())
    keep = keep.select(F.col("doc_id").alias("_keep"), F.col("key").alias("_key"))
    is_kept = docs["doc_id"].eqNullSafe(F.col("_keep")) & (F.xxhash64(docs["text"]) == F.col("_key"))
    kept = docs.join(keep, is_kept, "left_semi")
    twice = some.groupBy("doc_id", "key").agg(F.count("*").alias("_n")).where("_n > 1")
    twice = stored(twice.select(F.col("doc_id").alias("_twice"), F.col("key").alias("_same")), "repeated")
    if twice.isEmpty():
        return kept
    equal = kept["doc_id"].eqNullSafe(F.col("_twice")) & (F.xxhash64(kept["text"]) == F.col("_same"))
    return kept.join(twice, equal, "left_anti").unionByName(kept.join(twice, equal, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.decontaminated(docs.select(COLUMNS), require(spark, sf_dir, "benchmark"), k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, 0 to 2; documents without words stay once."""
    docs = docs.select(COLUMNS).withColumn("_key", F.xxhash64("text", F.lit(0)))
    copies = mixing.mix(docs).groupBy("doc_id", "_key").agg(F.max(F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))).alias("_copies"))
    copies = copies.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_text"), "_copies").where("_copies > 0")
    mixed = docs.join(copies, docs["doc_id"].eqNullSafe(F.col("_id")) & (docs["_key"] == F.col("_text")))
    return mixed.withColumn("_copy", F.explode(F.expr("sequence(1, cast(_copies as int))"))).select(COLUMNS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, shard and slot of every row; copies of a text share a shard where its quota allows."""
    return sharding.shard(docs, shards=16).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: SQL has no word for the learned model of the first stage; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = require(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
