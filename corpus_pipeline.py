"""Corpus pipeline: language identification, near-duplicate removal, benchmark decontamination, surrogates, mixing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame on all rows its predecessor kept; its result is written as
Parquet and read again as the next stage's ``docs``. All stages but the last return the columns of ``documents``; the
last adds ``copy`` and ``shuffle_key``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm import decontaminate, language_id, mixing, ngram_join, surrogates
from prelaunch.session import remove_path, scratch_path

LEAST_CONFIDENCE = 0.5       # a language below this posterior is not identified
KEY = "surrogates-v1"
READ = ("doc_id", "text", "lang", "source", "n_chars")   # the columns that stages read


def shield(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` with all other columns renamed by position, so that none can clash with a column that a stage adds, and
    the expressions that bring the names back."""
    safe = [c if c in READ else f"x_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*safe), [F.col(s).alias(c) for s, c in zip(safe, docs.columns)]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified stay: those with letters and a posterior of at least
    ``LEAST_CONFIDENCE``."""
    docs, columns = shield(docs)
    model = language_id.fit(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"), language_id.default_vocabulary())
    judged = language_id.predict(docs, model)
    kept = judged.where((F.col("w_lang") != language_id.UND) & (F.col("w_score") >= LEAST_CONFIDENCE))
    return kept.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest ``doc_id``."""
    docs, columns = shield(docs)
    return ngram_join.keep_representatives(docs).select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark passages go."""
    docs, columns = shield(docs)
    judged = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=docs.columns)
    return judged.where("not contaminated").select(*columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; ``n_chars`` follows the new text where it said the length of the old."""
    docs, columns = shield(docs)
    replaced = surrogates.replace_entities(docs.withColumn("w_length", F.length("text")), KEY)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.when(F.col("n_chars") == F.col("w_length"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return replaced.select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources are mixed to equal shares by Poisson replication and shuffled."""
    taken = {c.lower() for c in docs.columns}
    docs, columns = shield(docs)
    added = [F.col(c).alias(c if c not in taken else f"mix_{c}") for c in ("copy", "shuffle_key")]
    return mixing.mix(docs).select(*columns, *added)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
]

# Learned stages cannot be written in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; intermediate tables go to the shared checkpoint folder, and each is removed when the next
    stage's is written. Only the last one stays, which the result reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            remove_path(spark, before)
        before = f"{base}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
