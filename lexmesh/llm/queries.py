"""The registered queries of this subpackage: op1 to op10, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracles import ORACLES as ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge

    return judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import COUNTS, judge, learn

    docs = table(spark, sf_dir, "documents")
    return judge(docs, learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", *COUNTS, "base_failed", "kept")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import learn, score

    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents"))


@query
def op1_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngrams import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import score

    return score(table(spark, sf_dir, "documents"))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .pieces import encode

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
