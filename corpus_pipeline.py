"""From raw documents to a training mixture: language, near duplicates, benchmark leaks, personal data, weights.

Each stage takes (spark, docs, sf_dir), with docs as the stage before left them
in Parquet, and returns a DataFrame; all but the last return the columns of
`documents`. A stage begins by deleting the scratch tables of the stage before
in the same run, whose result has been written by then; other runs keep theirs.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import decontamination, language_id, minhash_dedup, mixing, pii, scratch
from tamis.session import staging_path


# The scratch tables of the stage before, by the run that they belong to: its thread and its folder.
_held: dict[tuple[int, str], dict[str, str | None]] = {}


def _staged(stage):
    """The stage, after the scratch tables of the stage before in the same run are deleted."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        run_key = threading.get_ident(), sf_dir
        scratch.delete(spark, _held.pop(run_key, {}))
        with scratch.recorded() as tables:
            found = stage(spark, docs, sf_dir)
        _held[run_key] = tables
        return found

    return run_stage


@_staged
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters and undecided ones go."""
    return language_id.identified(docs, language_id.train(docs.where(~language_id.held_out())))


@_staged
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash_dedup.deduplicate(docs)


@_staged
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that matches a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_staged
def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and revealing terms replaced in their texts."""
    clean = pii.sanitise(docs)
    text = {"text": F.col("_sanitised"), "n_chars": F.length("_sanitised").cast("long")}
    return clean.withColumns(text).select(*docs.columns)


@_staged
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: the words that each slot of each shard takes from a document."""
    _, pieces = mixing.mix(docs)
    return mixing.mixed_texts(docs, pieces)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("personal_data", remove_personal_data),
    ("mixture", mix_sources),
]

# Language identification is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of the documents of a folder; each stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    _held.pop((threading.get_ident(), sf_dir), None)  # an earlier run's result may still be read
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
