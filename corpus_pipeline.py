"""A corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
documents. All but the last return the columns of documents. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionflow.llm.frames import hand_off
from sessionflow.llm.language import UNKNOWN, with_languages
from sessionflow.llm.line_dedup import dedup_lines
from sessionflow.llm.ngram_join import representatives
from sessionflow.llm.packing import pack_documents
from sessionflow.llm.queries import ship, vocabulary
from sessionflow.llm.suffix_dedup import dedup_passages


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in languages that could be learnt, one or several; each row is judged by itself."""
    ship(spark)
    found = with_languages(docs).filter(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def _with_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the text that an operator left; n_chars follows the text."""
    kept = found.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that nearly repeat an earlier line; documents of which nothing is left go."""
    ship(spark)
    return _with_text(docs, dedup_lines(docs)).filter("trim(text) != ''")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return representatives(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that start earlier; documents of which nothing is left go."""
    ship(spark)
    return _with_text(docs, dedup_passages(docs)).filter("trim(text) != ''")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    ship(spark)
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [("language", language), ("lines", lines), ("near copies", near_copies), ("passages", passages), ("packing", packing)]

#: SQL can express neither the trained stages nor the tokenizer; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = hand_off(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
