"""Queries that apply the operators to the whole test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import id_crc
from tapeworks.llm.line_dedup import line_dedup
from tapeworks.llm.merkle import merkle_manifest
from tapeworks.llm.mixture import mixture
from tapeworks.llm.ngram_join import ngram_join
from tapeworks.llm.nn_descent import nearest_neighbours
from tapeworks.llm.oracle import ORACLE  # noqa: F401
from tapeworks.llm.packing import pack_documents
from tapeworks.llm.periodic import periodic_runs, planted
from tapeworks.llm.quality_rules import quality_rules
from tapeworks.llm.secret_scan import secret_scan
from tapeworks.llm.token_counts import token_counts
from tapeworks.llm.token_files import read_token_files, write_token_files
from tapeworks.llm.warc import page_of, read_warc, write_warc
from tapeworks.llm.weak_quality import weak_quality
from tapeworks.session import shared_dir

TOKENIZER = "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(_documents(spark, sf_dir))
    return rules.withColumn("host_rate", F.round("host_rate", 9))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    write_token_files(_documents(spark, sf_dir), folder, public_tokenizers.path(TOKENIZER))
    return read_token_files(spark, folder)


def op5_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality(_documents(spark, sf_dir)).select("doc_id", "quality_score", "quality_kept")


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_documents(spark, sf_dir))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors["vec_id"] % 20 == 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    chosen = id_crc(docs["doc_id"]) % 7 == 0
    # A decimal, since the greatest long has no successor.
    tampered = F.when(chosen, docs["n_chars"].cast("decimal(20, 0)") + 1).otherwise(docs["n_chars"])
    proofs = merkle_manifest(docs, {"n_chars": tampered})
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                         "folded_root", "verified")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = read_warc(spark, folder, payloads=False).where("record_type is null or record_type <> 'warcinfo'")
    # A record with a problem ends the query.
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(" ", "archive", "offset", "problem")))
    return records.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                          sound.alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(planted(_documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                                F.lit("\n"))), "")
    found = runs.select("doc_id", "runs", "collapsed", longest.alias("longest"), lines.alias("lines"))
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_packing, op3_secret_scan, op4_token_files, op5_weak_quality, op6_mixture,
        op7_nearest_neighbours, op8_token_counts, op9_ngram_join, op10_line_dedup,
        op11_merkle_manifest, op12_warc, op13_periodic_runs)}
