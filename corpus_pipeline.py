"""Corpus pipeline: from ``documents`` to packed token sequences.

    language    documents in no language that was learnt go (CRF language ID)
    line_dedup  lines that at least 10 documents hold go (Bloom filters, exact counts)
    near_dedup  one document of each near-copy group stays (SimHash, 3 bits)
    pack        whole texts into sequences of 1024 tokens (reduction, best fit)

Each stage takes the documents its predecessor kept, written as Parquet. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import crf_lang, line_dedup, packing, scratch, simhash

#: A document goes if its letter n-grams are less familiar than this part of
#: what held-out documents usually are (junk, or a language not learnt).
LEAST_FAMILIAR = 0.7


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learnt language, mixtures too; a missing ``lang`` is filled in."""
    found = crf_lang.identify(docs.withColumnsRenamed({"lang_pred": "_lang_pred", "score": "_score"}),
                              least_familiar=LEAST_FAMILIAR)
    kept = found.where(F.col("lang_pred") != crf_lang.UNDETERMINED)
    return (kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
            .withColumnsRenamed({"_lang_pred": "lang_pred", "_score": "score"}).select(*docs.columns))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the lines that at least 10 documents hold."""
    out = line_dedup.line_dedup(docs, min_docs=10, min_chars=1, keep="none")
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(
        docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return simhash.near_dedup(docs, words=3, radius=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents left, with their sequence and place."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [("language", language), ("line_dedup", repeated_lines), ("near_dedup", near_copies), ("pack", pack)]

#: The first and third stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's output stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
