"""A training corpus from documents: quality, line dedup, near duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
rereads as the next one's ``docs``. All but the last return the columns of documents. Rows without a text
hold no words: they pass the quality stage, are alone in the join and are left out by the mixture.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import WORD, stored
from tapeworks.llm.line_dedup import line_dedup
from tapeworks.llm.mixture import mixture
from tapeworks.llm.ngram_join import ngram_join
from tapeworks.llm.packing import pack_documents
from tapeworks.llm.weak_quality import weak_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return weak_quality(docs).where("quality_kept").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; those of which no word is left go."""
    return (line_dedup(docs)
            .where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
            .withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars"))
                        .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
            .select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of equal rows one stays. Rows without an id come last; an id that several texts share names each of them
    together with its text.
    """
    # Nullable like what is read back, so that both have one type.
    none = F.nullif(F.col("doc_id").isNull(), F.lit(None).cast("boolean"))
    named = docs.withColumn("doc_id", F.struct(none.alias("none"), "doc_id", F.md5("text").alias("key")))
    groups = ngram_join(named).where(F.col("doc_id").eqNullSafe(F.col("group_id")))
    kept = groups.select(F.col("doc_id.doc_id").alias("kept_id"), F.col("doc_id.key").alias("kept_key")).distinct()
    return (docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"])
                      & F.md5(docs["text"]).eqNullSafe(kept["kept_key"]), "left_semi")
            .select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A document at the edge of a source's share is taken in part; it comes once for the part if that is
    half of it or more.
    """
    keyed = docs.withColumn("key", F.md5("text"))
    others = [c for c in COLUMNS if c not in ("doc_id", "text", "source")]
    taken = mixture(keyed, keep=("key", *others)).where(F.col("size") > 0).withColumn(
        "times", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
    # Equal rows are taken each as often as its own place says, together the sum.
    names = ["doc_id", "key", "source", *others]
    taken = taken.where("times > 0").groupBy(*[F.col(c).alias(f"t_{c}") for c in names]).agg(
        F.sum("times").cast("int").alias("times"))
    taken = stored(taken, "mix-times")
    one = keyed.where(F.col("text").rlike(WORD)).dropDuplicates(names)
    return (one.join(taken, [one[c].eqNullSafe(taken[f"t_{c}"]) for c in names])
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: one row per piece of a document."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]
# No SQL: learned scores, seeded hashes and tokens are beyond it; the tests hold it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
