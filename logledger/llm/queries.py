"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.llm import (kneser_ney, merkle, mixing, packing, quality_classifier, quality_rules, recompression,
                           secrets, simhash, token_counts, vector_join, warc, whitening)
from logledger.llm.common import table
from logledger.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed", "kept")


ORACLE["op10_quality_rules"] = f"""WITH {quality_rules.oracle_cte()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken(mixing.mix(docs)).select("doc_id", "size", "source", "source_size", "target", "taken")


ORACLE["op9_mixing"] = mixing.oracle()


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are the documents' sources, repositories their languages within a source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = secrets.scan(docs, owner=F.col("source"), repo=F.col("lang"))
    return secrets.summarize(docs, found).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans",
        "n_live", "n_example")


ORACLE["op5_secret_scan"] = f"WITH {secrets.oracle()}"


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    read = warc.archive_round_trip(pages, scratch_path(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op1_warc"] = warc.oracle()


@query
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op2_embedding_near_dedup"] = vector_join.oracle()


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = kneser_ney.held_out(F.col("doc_id"))
    model = kneser_ney.train(docs.filter(~out), scratch_path(spark, "kneser-ney"), order=kneser_ney.ORDER)
    return kneser_ney.score(docs, model).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    model = quality_classifier.train(docs, labels.filter(rest != 1))
    return quality_classifier.classify(docs, model).select("doc_id", (rest == 1).alias("held_out"), "score", "predicted")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    return merkle.manifest(docs, tampered=merkle.without_newlines())


ORACLE["op13_merkle_manifest"] = merkle.oracle()


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return recompression.find_repeats(spark, docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op12_substring_dedup"] = recompression.oracle()


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
