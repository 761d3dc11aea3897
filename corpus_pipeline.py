"""Corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Edge cases: a null or empty text fails the base rules and goes in the first
stage; documents without an id pass the rules by their text and are compared
with nothing later, so they reach the last stage; repeated rows stay until the
join, which keeps all rows of the document that stays; other columns pass
through whatever their names, up to the last stage; an empty table gives an
empty one; without labels the base rules decide alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postatlas.llm import decontaminate, line_dedup, ngram_join, quality, sentencepiece_codec
from postatlas.llm.queries import table, tokenizer
from postatlas.llm.scale import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; n_chars follows the text; texts without words left go."""
    out = line_dedup.drop_lines(docs)
    out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of any benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of ids and of the decoded text."""
    return sentencepiece_codec.token_digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", near_duplicates),
    ("decontaminate", decontamination),
    ("sentencepiece", encoding),
]
#: The forest, the edit distances, the components and the encoding have no form in SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; stages are written under the shared checkpoint folder."""
    base = f"{checkpoint_dir(spark)}/corpus_pipeline_{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{base}/{k}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
