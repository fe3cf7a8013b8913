"""The corpus pipeline: each stage is one operator whose decisions take effect on the documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm import decontaminate, near, packing, substrings, toxicity
from martweave.llm.queries import tokenizer_json
from martweave.session import delete_path, scratch_path, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(docs, labels).where(F.col("_toxic") == 0).drop("_score", "_toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages of 35 words or more that stand in several places are cut from their texts."""
    cut = substrings.remove_repeats(docs)
    n_chars = F.when(F.col("_n_removed") > 0, F.length("_kept").cast("bigint")).otherwise(F.col("n_chars"))
    changed = cut.withColumns({"text": F.col("_kept"), "n_chars": n_chars})
    return changed.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, neighbours on the curve together."""
    return packing.pack(docs, tokenizer_json())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages learn models and hash texts, which SQL cannot express; a test compares ``run`` with plain Python on a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each one's rows are written and read again by the next.

    What a stage keeps in scratch goes when its rows are written, and these go when the next stage has read them.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
