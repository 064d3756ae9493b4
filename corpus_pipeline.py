"""The corpus pipeline: stages that each apply one corpus operator to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from menulake.llm.common import Tables, table
from menulake.llm.decontaminate import without_benchmark
from menulake.llm.line_quality import good_documents
from menulake.llm.mix import mixed_documents
from menulake.llm.near_copies import without_near_copies
from menulake.llm.token_files import read_tokens, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the line field calls bad (operator 2)."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies (operator 5)."""
    return without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item or a passage of one (operator 6)."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the sources at weights 1, 2, 3 in turn: a row for each time a text is taken (operator 7)."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token folder and reads it back: a row for each document's ids (operator 8)."""
    path = Tables(spark, "tokens").root
    write_tokens(docs, path)
    return read_tokens(spark, path, digest=True)


STAGES = [("quality", quality), ("near dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("token files", token_files)]

#: The line field, the signatures and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read back as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    tables = Tables(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = tables.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        tables.drop(before)
        before = docs
    return docs
