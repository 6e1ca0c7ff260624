"""Training-corpus pipeline over ``documents``: five stages in order.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; ``run`` writes each result as Parquet in the shared folder and rereads it
as the next stage's input.  All stages but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewarden.llm import boosted_quality, bpe_automaton, decontaminate, secret_scan, simhash_dedup
from slicewarden.llm.common import read_table, stored
from slicewarden.llm.queries import word_bpe_path

# The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    model = boosted_quality.train(docs, read_table(spark, sf_dir, "labels"))
    row = F.struct(*docs.columns).alias("row")
    return boosted_quality.score(docs.select(row, "text"), model).where("predicted = 1").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id."""
    return simhash_dedup.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    clean = secret_scan.redact(docs, secret_scan.cutoffs(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its packed token ids and their number."""
    return bpe_automaton.encode(docs, word_bpe_path()).drop("decoded")


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", clean_of_benchmark), ("secret scans", secrets), ("bpe encoding", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
