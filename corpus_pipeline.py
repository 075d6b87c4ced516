"""From documents to token files: the stages of the training-data pipeline.

Each stage takes the rows that the one before it kept; its result is written
and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from surgewatch.llm import decontam, jaccard, langid, mixing, token_frames
from surgewatch.llm.common import dropped, noted, saved
from surgewatch.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Intermediate tables of the stage that ran last.
_used: list[str] = []


def _stage(function: Stage) -> Stage:
    """Delete the intermediate tables of the stage before, whose result is written by now.

    Tables that ``docs`` itself still reads, as when nothing was written in between, stay.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        files = docs.inputFiles() if _used else []
        done = [path for path in _used if not any(path in file for file in files)]
        dropped(spark, done)
        with noted() as paths:
            result = function(spark, docs, sf_dir)
        _used[:] = [path for path in _used if path not in done] + paths
        return result

    return run


@_stage
def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.keep_identified(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs)


@_stage
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: ids' place, number and checksum per document."""
    return token_frames.digest(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_languages),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_files", tokenise),
]

#: SQL has neither the tokenizer nor the n-gram profiles.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's result is deleted once the next one's is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        with noted() as paths:
            docs = saved(kept, name)
        dropped(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
