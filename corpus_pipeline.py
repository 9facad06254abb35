"""The corpus pipeline: documents -> quality -> near-duplicates -> benchmark leaks -> mix -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.

All stages take any rows. Null texts count as empty; an empty text is scored,
fingerprinted (all of them are one group of near-duplicates), holds no
benchmark window, takes no part in the mix (it has no words), and in the token
files is an end id. Rows without a doc_id are kept like others, but of a group
one with an id is preferred; repeated ids and repeated rows are rows of their
own until near-duplicates go. Very long texts pass whole. Further columns, also
of names that stages use themselves, stay as they are. Without labels nothing is
rejected, without benchmark windows nothing is contaminated, and an empty table
gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import decontamination, mixing, quality, simhash, tokenids
from emporia.llm.common import materialise, new_folder, prepare, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on all labelled documents at hand, does not reject."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.accepted(docs, quality.fit(docs, labels))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    prepare(spark)
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    prepare(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: one row per copy of a document that it takes, in the order of training positions."""
    prepare(spark)
    return mixing.mixture(docs)


def token_ids_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token-id files in the order of training, and per document what is read back from them.

    The order is that of the rows in the Parquet files of ``docs``. Files are
    numbered with five digits or more, so a longer name comes later.
    """
    prepare(spark)
    path = new_folder(spark, "token-files")
    name = F.col("_metadata.file_name")
    tokenids.write(docs, path, order=[F.length(name), name, F.col("_metadata.row_index")])
    return tokenids.summary(spark, path)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_ids_stage),
]

# Trained scores, fingerprints and token ids are not SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and reread by the next."""
    prepare(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
