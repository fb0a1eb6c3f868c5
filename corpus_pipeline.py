"""A training corpus from raw documents: language ID, near duplicates, repeated passages, mixing, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
documents, the last one packed pieces. run() writes what each stage returns to the shared folder and reads it again as
the next one's docs, so each stage works on all that its predecessor kept. What a stage returns must be written before
the next stage is called, which deletes the scratch tables of the one before."""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deltaloom.llm import language, mixing, packing, simhash, suffixes
from deltaloom.llm.common import made_paths, release, remove, scratch, table, written


#: left: the scratch tables of the last stage that this thread called.
_own = threading.local()


def stage(work: Callable) -> Callable:
    """work, after the scratch tables of the stage before are gone and the driver's Python has given back what it freed."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _own.__dict__.get("left", []))
        release()
        before = len(made_paths())
        out = work(spark, docs, sf_dir)
        _own.left = made_paths()[before:]
        return out

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with the calibrated confidence."""
    return language.identified(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest doc_id."""
    return simhash.without_near_duplicates(docs)


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages that stand earlier."""
    return suffixes.without_repeats(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("simhash", near_duplicates), ("suffix_dedup", repeated_passages), ("mixing", mix), ("packing", packed)]

#: No SQL: learned models, hashes and packing decide the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, work in STAGES:
        docs = written(work(spark, docs, sf_dir), scratch(spark))
    return docs
