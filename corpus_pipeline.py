"""The corpus pipeline: quality rules, SimHash near-dedup, secret scan, mixing and packing of ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet below the shared checkpoint folder and
read again.  All but the last return the columns of ``documents``; other columns
of their input are ignored.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.llm import mixing, packing, quality_rules, secrets, simhash
from logledger.llm.common import table
from logledger.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep."""
    docs = docs.select(*COLUMNS)
    named = docs.withColumn("_text_key", secrets.text_key(F.col("text")))
    kept = quality_rules.judge(named).filter("kept").select(
        F.col("doc_id").alias("_k"), F.col("_text_key").alias("_x")).distinct()
    return named.join(kept, F.expr("doc_id <=> _k and _text_key = _x"), "left_semi").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, and of its repeated rows one."""
    docs = docs.select(*COLUMNS)
    named = docs.withColumn("_text_key", secrets.text_key(F.col("text")))
    linked = simhash.near_duplicates(named.select("doc_id", "text", "_text_key"))
    first = linked.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull(), F.col("doc_id").alias("_k"), F.col("_text_key").alias("_x"))).alias("f"))
    same = named.join(first.select("f._k", "f._x"), F.expr("doc_id <=> _k and _text_key = _x"), "left_semi")
    return same.dropDuplicates(["doc_id", "_text_key"]).select(*COLUMNS)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with live secrets masked; copied examples stay."""
    docs = docs.select(*COLUMNS)
    found = secrets.scan(docs, owner=F.col("source"), repo=F.col("lang"))
    return secrets.redact(docs, found).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as weighted fair queueing takes them."""
    path = scratch_path(spark, "pipeline-mixing-rows")
    docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = mixing.taken(mixing.mix(rows, row="_row")).filter("copies > 0").select("uid", "copies")
    served = rows.join(counts, F.expr("_row = uid"))
    return served.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's pieces, each a sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = docs.select(*COLUMNS)
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_dedup), ("secret_scan", scan_secrets),
          ("mixing", mix_sources), ("packing", pack)]

#: SimHash and byte-level BPE have no SQL form; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
