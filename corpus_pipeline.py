"""The training-data pipeline: five stages over documents, each a call of one corpus operator.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame; ``run`` writes
each result as Parquet into the shared scratch folder and reads it again as the next stage's documents.  All stages but
the last return the columns of documents.  Rows without doc_id are judged by their text alone and pass the stages that
compare documents.  An empty table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolith.llm.common import Written, table
from cartolith.llm.decontamination import clean_documents
from cartolith.llm.minhash import near_duplicates
from cartolith.llm.mixing import mix_sources
from cartolith.llm.quality import classify
from cartolith.llm.substrings import substring_dedup


def _staged(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's rows with the columns of docs; those that an operator's own names could clash with are renamed meanwhile."""
    own = {c: f"own{c}" for c in docs.columns if c.startswith("__")}
    return stage(docs.withColumnsRenamed(own)).select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (posterior below one half) go."""
    return _staged(docs, lambda d: classify(d, table(spark, sf_dir, "labels")).where("__quality >= 0.5"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document of least doc_id stays."""
    gone = near_duplicates(docs, percent=80).where(~F.col("kept")).select(F.col("doc_id").alias("__gone"), F.col("th").alias("__th"))
    gone = Written(gone.distinct(), "near-duplicates").sized()
    return _staged(docs, lambda d: d.join(gone, (d["doc_id"] == gone["__gone"]) & (F.xxhash64(d["text"]) == gone["__th"]), "left_anti"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds already are cut out of the text."""

    def cut(d: DataFrame) -> DataFrame:
        x = substring_dedup(d)
        if "n_chars" in docs.columns:
            n_chars = F.when(F.col("__n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
            x = x.withColumn("n_chars", n_chars)
        return x

    return _staged(docs, cut)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return _staged(docs, lambda d: clean_documents(d, table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, target, rate, copies and taken; those of no copies are not in it."""
    return mix_sources(docs).where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passages", passages),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
]

#: The classifier, SuperMinHash and the gear hash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = Written(docs, name).df
    return docs
