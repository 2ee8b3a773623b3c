"""The training-data pipeline over ``documents``.

``STAGES`` are (name, function) pairs; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  Every stage's result is written as Parquet
into the shared folder and reread as the next one's ``docs``.  All stages but the
last keep the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm import exact_dedup, lang_id, mixing, packing, simhash
from touchcredit.llm.common import pin


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, however alike the languages score; all of them when nothing is labelled."""
    model = lang_id.train(docs.filter(~lang_id.held_out()))
    if not model.languages:
        return docs
    found = lang_id.predictor(spark, model)(F.col("text"))
    return docs.filter(found["lang_pred"] != lang_id.UNKNOWN)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs, stored=True)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_stage), ("exact_dedup", exact_stage), ("simhash_near_dedup", near_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

ORACLE_SQL = None  # fingerprints, sampling by hashes and tokenisation are beyond SQL; tests/llm use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
