"""Five stages from raw documents to a training mix, each one operator of ``playerlens.llm``.

A stage gets what its predecessor kept and returns the columns of ``documents``; the last one, the
mix, adds how often each document is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.scratch import with_scratch
from playerlens.llm import secrets
from playerlens.llm.decontaminate import decontaminate as without_benchmark
from playerlens.llm.language import with_language
from playerlens.llm.minhash import near_duplicates
from playerlens.llm.mixing import mix
from playerlens.llm.text import set_aside
from playerlens.session import cut_lineage, prepare


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no dictionary ahead on a longer text."""
    docs, columns = set_aside(docs, ["lang_pred", "score", "margin", "rejected"])
    return with_language(docs).filter(~F.col("rejected")).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Rows that repeat the id of a kept document and its text are dropped but for one; rows without
    an id all stay.
    """
    kept = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of benchmark items; documents that are mostly benchmark go as a whole."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(without_benchmark(docs, items))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    found = cut_lineage(secrets.scan(docs.select("text")).drop("text"))
    return _with_length(secrets.redact(docs, secrets.learn(found, docs)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``copies``."""
    mixed = mix(docs).filter("copies > 0")
    return mixed.select(*docs.columns, "copies")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_scratch(prepare(spark)).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
