"""Corpus pipeline: language ID, quality, near-duplicates, benchmark decontamination, packing, one after the other.

Every stage works on all documents that the one before has kept, and is written before the next one reads it. All but the
last return the columns of ``documents``. The quality stage learns from ``labels``, decontamination reads ``benchmark``.

Defined results: a document without a letter is dropped by the first stage; of rows with the same id and text one stays;
documents without an id stay where ids decide. Without labels the second stage keeps all. Empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.llm import decontam, jaccard, langid, packing, quality
from lodebar.llm.common import dropped, freed, read_table, small_batches, staged

#: The packed sequences' tokenizer; a parameter of the packing operator.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Words that a packing worker remembers: few, as the workers of all stages share an executor's memory.
TABLE_WORDS = 100_000

#: Shares below this have no leading language; such documents are rejected.
LEADING_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter, or without a language for half of the text, go."""
    small_batches(spark)
    judged = langid.predict(docs, langid.learn(docs))
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEADING_SHARE)).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good ones selects."""
    small_batches(spark)
    judged = quality.resample(docs, read_table(spark, sf_dir, "labels"))
    return judged.where("keep").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    judged = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return judged.where("not contaminated").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their sequences and places."""
    small_batches(spark)
    return packing.pack(docs, TOKENIZER, table_words=TABLE_WORDS)


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: Fitted models and exact set joins of texts are beyond SQL at this size; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        before, docs = docs, stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = staged(docs, f"stage-{n}")
            if n > 1:
                dropped(before)
            freed(spark)
    return docs
