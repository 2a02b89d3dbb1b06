"""Fuzzy joins of names by shared words, as equi-joins on the words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh.functions import text as T


def shared_words(left: DataFrame, right: DataFrame, lkey: str, rkey: str, ltext: str, rtext: str, least: int = 5) -> DataFrame:
    """(lkey, rkey, common, n_left, n_right) of all pairs that share a word of `least` characters.

    Words are the join keys, so pairs without one are never met. The result has
    every pair that shares a word, so a word of all rows makes all pairs: very
    frequent words should be removed by the caller as stop words. A word of many
    rows is split by adaptive execution (spark.sql.adaptive.skewJoin), as both
    sides come straight from their exchanges.
    """
    sets = lambda df, key, text, name: df.select(F.col(key).alias(name), T.keywords(F.col(text), least).alias("_w")).select(name, F.size("_w").alias(f"n_{name}"), F.explode("_w").alias("_w"))
    a, b = sets(left, lkey, ltext, "left"), sets(right, rkey, rtext, "right")
    return a.join(b, "_w").groupBy("left", "right").agg(F.count("*").alias("common"), F.first("n_left").cast("long").alias("n_left"), F.first("n_right").cast("long").alias("n_right"))


def duplicates(units: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b): every unit b whose matching key is that of an earlier unit, with the first such unit a."""
    keyed = units.select(F.col(key).alias("b"), F.sha2(T.match_key(F.col(text)).cast("binary"), 256).alias("_k"))
    first = keyed.groupBy("_k").agg(F.min("b").alias("a"))
    return keyed.join(first, "_k").where("b <> a").select("a", "b")


def overlapping(pairs: DataFrame, least: int = 2) -> DataFrame:
    """Rows of `left` that share at least `least` words with some right."""
    return pairs.where(F.col("common") >= least).select("left").distinct()


def contained(pairs: DataFrame, ratio: float = 0.6, least: int = 2) -> DataFrame:
    """Pairs with enough common words, or enough of the smaller set."""
    return pairs.withColumn("ratio", F.round(F.col("common") / F.least("n_left", "n_right"), 4)).where((F.col("common") >= least) | (F.col("common") / F.least("n_left", "n_right") >= ratio))


def best_jaccard(pairs: DataFrame, least: float = 0.3) -> DataFrame:
    """(left, right, jaccard): the best right of each left; the smaller id wins ties."""
    scored = pairs.withColumn("jaccard", F.col("common") / (F.col("n_left") + F.col("n_right") - F.col("common"))).where(F.col("jaccard") >= least)
    return scored.groupBy("left").agg(F.max_by(F.struct("right", "jaccard"), F.struct("jaccard", (-F.col("right")).alias("o"))).alias("b")).select("left", "b.right", F.round("b.jaccard", 4).alias("jaccard"))


def delimitation(in_reference: Column, in_corpus: Column, missing: Column) -> Column:
    """MANTENER, FALTANTE or REVISAR of a norm by where it was found."""
    return F.when(missing, "FALTANTE").when(in_reference & in_corpus, "MANTENER").when(in_corpus & ~in_reference, "REVISAR").otherwise("FALTANTE")
