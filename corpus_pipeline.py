"""A corpus from raw documents to packed training sequences.

Each stage takes all documents that the one before it kept, and is written as Parquet and read again. All but the last return the columns of
``documents``; ``n_chars`` follows the text. The last returns the pieces with their ids and places. A stage's result must be written before the next stage is
called, which removes what it was made from.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.llm import benchmarks, languages, lines, nearcopies, packing
from sessionvol.session import folder_mark, folders_since, new_folder, remove_folders

#: Intermediate tables of the last stage that was called, by application.
_left: dict[str, list[str]] = {}


def _frees(stage: Callable) -> Callable:
    """A stage that first removes what the stage before it stored on its way: its output is written by then."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        remove_folders(spark, *_left.pop(application, []))
        mark = folder_mark()
        out = stage(spark, docs, sf_dir)
        _left[application] = folders_since(mark)
        return out

    return run_stage


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


@_frees
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go."""
    return languages.keep_known(docs, languages.learn(docs))


@_frees
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents that had no other."""
    return _counted(lines.remove_lines(docs))


@_frees
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return nearcopies.drop_near_copies(docs)


@_frees
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(benchmarks.remove_passages(docs, items))


@_frees
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express none of the learnt, near-duplicate and tokenising stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, former = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        remove_folders(spark, *former)  # what this stage has read
        former = [folder]
    return docs
