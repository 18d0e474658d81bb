"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and decides on all its predecessor kept; between stages the
documents are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import table
from skyweave.llm.mixing import mix
from skyweave.llm.packing import pack
from skyweave.llm.secrets import redact
from skyweave.llm.simhash import deduplicate
from skyweave.llm.toxicity import score, train
from skyweave.session import stage

TOXIC = 0.3  # documents that score as much or more go


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine trained on all labels does not reject. Null and empty texts stay."""
    machine = train(spark, docs, table(spark, sf_dir, "labels"))
    packed = score(spark, docs.select(F.struct("*").alias("doc"), F.col("text")), machine)
    return packed.where(F.col("toxicity") < TOXIC).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; all texts without words are one group."""
    return deduplicate(spark, docs, words=4, distance=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and n_chars counted anew where that changed a text."""
    packed = redact(spark, docs.select(F.struct("*").alias("doc"), F.col("text")))
    text = F.col("text")
    changed = text.isNotNull() & (text != F.col("doc.text"))
    values = {"text": text, "n_chars": F.when(changed, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))}
    return packed.select(*[values.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix of sources takes; without copies it goes."""
    mixed = mix(spark, docs, weights=(1, 2, 3), repeats=3, whole_rows=True).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

# Trained weights, Newton steps and a tokenizer decide here; tests hold the stages against plain models instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that the stages leave."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
