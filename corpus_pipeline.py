"""Pipeline over a corpus: documents in, packed sequences out.

Quality rules and the quality classifier drop documents, line dedup removes repeated passages (and documents
of which nothing is left), near-duplicate classes keep one document each, and what remains is packed into
sequences. Every stage works on all rows that its predecessor kept and, but for the last, returns them with
the columns of documents.

Defined results: a null or empty text has too few words and goes with the first stage, as do all texts under twenty
words; documents without id or language stay like others; of rows equal in id and text one stays; texts of any length
are worked on whole; ties go as the stages say; further columns, whatever their names, are kept until the last stage; an
empty table gives no row.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import line_dedup, near_dedup, packing, quality_classifier, quality_rules
from tallyloom.llm.common import table
from tallyloom.session import stored

ORACLE_SQL = None  # the classifier's model and the linear programme have no SQL; tests compare with brute force


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.kept_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_per_class(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, vocabularies.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the documents below ``sf_dir``; each stage is stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
