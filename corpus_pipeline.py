"""The corpus pipeline: language ID, near duplicates, decontamination, personal data, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last return the columns
of documents. ``run`` applies them to documents.

Defined cases, of every stage. Rows of null doc_id are kept where their text is not rejected, as they can't be told apart by id. Repeated rows
stay or go together. An empty table gives an empty one with the same columns. Columns beyond those of documents are kept as they are, whatever their names, by all but the last stage,
which reads doc_id and text alone. Null, empty and very long texts, and ties, are said for each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from voxweave.llm import bpe, decontam, jaccard, langid, pii
from voxweave.llm.util import ensure_checkpoint_dir, remove, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't text in any of the labelled languages go: null, empty and letterless texts too. Very long texts are judged whole. Of languages with equal rates the first by name counts."""
    return langid.accepted(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the lowest doc_id stays. Null, empty and wordless texts are copies of nothing and stay. Very long texts are compared whole."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, however long they are. Null and empty texts hold none. A document with several items goes once."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; all documents stay. Null stays null, empty empty; very long texts are searched whole. Of overlapping spans the first in the order of kinds is replaced."""
    return pii.redact(docs, pii.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every document; what null and empty texts give is said in ``bpe.encode``. Equal merges are made from the left."""
    return bpe.encode(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Cross-parsing, expectation-maximisation and BPE can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:  # read by nobody any more
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
