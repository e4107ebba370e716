"""Stages of the corpus pipeline: each calls one operator and returns the documents it keeps.

All of them read the columns of ``documents`` (``COLUMNS``) by name and return just these, whatever
extra columns their input has; the last one returns pieces.  An empty table gives an empty one, and so does an
empty ``benchmark`` leave all documents.  Very long texts are handled whole.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from issuelens.llm import decontaminate, jaccard, packing, passages, quality
from issuelens.llm.common import pick, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep.

    Null, empty and blank texts, and all of fewer than ten words, go.  Repeated rows and rows without an id are judged
    each by their text, so they stay or go together.
    """
    return quality.quality(docs, carry=COLUMNS).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least doc_id (one row, should it repeat).

    Null and empty texts are copies of each other, so one of them stays; a class without any id keeps one row.
    Where a class's least doc_id has several texts, the row that comes first in the input stays.
    """
    classes = jaccard.jaccard_classes(docs)
    firsts = classes.where("first").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    d = pick(docs, *COLUMNS).withColumn("_text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    met = d.join(firsts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    return met.dropDuplicates(["_id", "_key"]).select(*COLUMNS)


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of smaller ones; a text that loses words is its kept words joined by a space.

    Documents that lose all their words go; texts without words (null, empty) stay as they are.  A missing
    doc_id comes after all others; rows of one doc_id cut nothing from each other, so repeated rows stay.
    A text that loses nothing keeps its white space and its n_chars; else n_chars is that of the new text.
    """
    cut = passages.dedup_passages(docs, carry=COLUMNS)
    some = F.col("n_removed") > 0
    cut = cut.where("n_words = 0 or n_removed < n_words")
    return cut.select("doc_id", F.when(some, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source", F.when(some, F.length("kept_text").cast("long")).otherwise(F.col("n_chars").cast("long")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window.

    Texts without words (null, empty) stay; repeated rows go or stay together, also those without an id.
    """
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS).where("not contaminated").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences.

    A null or empty text is one piece, its end id; repeated rows and rows without an id are packed each.
    """
    return packing.pack(docs)
