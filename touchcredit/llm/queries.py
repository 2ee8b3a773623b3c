"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, infill, lang_id, mixing, packing, passages, pii, simhash, token_codec, token_counts, topk, warc, whitening


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark, sf_dir):
    return lang_id.identify_languages(documents(spark, sf_dir))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_files(spark, sf_dir):
    return token_codec.token_file_round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_personal_data(spark, sf_dir):
    return pii.personal_data(documents(spark, sf_dir))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_warc(spark, sf_dir):
    return warc.warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_mixing(spark, sf_dir):
    return mixing.mix_sources(documents(spark, sf_dir))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), stored=True)


def op10_top_k(spark, sf_dir):
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op11_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_passages(spark, sf_dir):
    return passages.passage_digests(documents(spark, sf_dir))


def op13_fill_in_middle(spark, sf_dir):
    return infill.fim_digests(documents(spark, sf_dir))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_token_counts, op3_token_files, op4_personal_data, op5_simhash,
                            op6_packing, op7_warc, op8_mixing, op9_exact_dedup, op10_top_k, op11_whitening, op12_passages, op13_fill_in_middle, pipeline)}
