"""The corpus pipeline: language ID, quality, near-duplicates, personal data, packing.

Each stage works on all documents that its predecessor kept.  ``run`` writes every stage's
result to the shared folder before the next one reads it.  The models are learnt here from the
stage's own documents, so the rows cannot be expressed in SQL: the tests hold every stage
against its operator and a brute-force version (``tests/llm/test_pipeline.py``).

Defined results: a null or empty text has no letter, so the first stage drops it; rows without
``doc_id`` are judged by their text, are near-duplicates of nothing and stay; rows that repeat a
``doc_id`` stay or go together; equal texts are one group, whose least id stays; a null ``lang`` is a class
of its own; texts of any length are whole; an empty table gives no pieces.  Columns that the stages don't
name pass through, whatever they are called, up to packing; ``n_chars``, if it is there, follows the redacted text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curata.llm import catalog, language, neardup, personal, quality
from curata.llm.common import lighten, moderate_batches, read, stage

#: A document whose language is told with a lower score goes; one without any letter scores 0.
LEAST_LANGUAGE_SCORE = 0.3
#: Near copies share this percent of their runs of five words; the thin query op8 has a threshold of its own.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told stay."""
    moderate_batches(spark)
    machines = language.fit(docs)
    lighten(spark)  # of the sample
    return language.keep_identified(docs, machines, LEAST_LANGUAGE_SCORE)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as predictable as trusted text of their language stay."""
    moderate_batches(spark)
    lighten(spark)
    return quality.keep_good(docs, catalog.trusted_ids(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    moderate_batches(spark)
    lighten(spark)
    return neardup.keep_one(docs, percent=NEAR_PERCENT)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text is replaced."""
    lighten(spark)
    done = personal.redact(docs, personal.fit(docs))
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their ids."""
    moderate_batches(spark)
    lighten(spark)
    return catalog.pieces(docs)


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal", redact_personal),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs)
    return docs
