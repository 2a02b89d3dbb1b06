"""A corpus pipeline: toxicity, quality rules, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it
kept, and all but the last give back the columns of docs, whatever else these
are called. Null ids are ids like others but for near duplicates, which keep all
rows without one. Empty tables give empty tables. Texts of any length are
treated whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.llm import ngrams, packing, quality, suffixes
from lexmesh.llm import toxicity as tox
from lexmesh.llm.common import drop_scratch, materialize, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; a null or empty text isn't, and repeated rows stay."""
    model = tox.learn(docs, _labels(spark, sf_dir))
    rows = docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("_row"), "text")
    left = tox.passing(rows, model, "_row", with_text=True)
    return left.select(*("text" if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep; null and short texts go, repeated rows stay."""
    rules = quality.learn(docs, _labels(spark, sf_dir))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return quality.passing(rows, rules, "_row").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; rows that repeat it go as well."""
    return ngrams.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that strings of 200 bytes cover which start elsewhere too; a null text becomes empty, n_chars is the new length."""
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    other = F.struct(*(c for c in docs.columns if c not in new))  # the text travels once
    left = suffixes.repeated_spans(docs.select("doc_id", "text", other.alias("_row")), keep_cols=("_row",), with_text=True)
    return left.select(*(new[c].alias(c) if c in new else F.col("_row")[c].alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids that fill whole sequences; a null or empty text is one piece of its end id."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", packed),
]

#: SQL can't express the learned and the iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = len(written)
        docs = materialize(stage(spark, docs, sf_dir), name)
        drop_scratch(spark, written[before:-1])  # what the stage wrote for itself
    return STAGES[-1][1](spark, docs, sf_dir)
