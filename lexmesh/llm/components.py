"""Connected components by alternating star operations (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions


def with_value(edges: DataFrame, values: DataFrame, hot: int, key: list[str]) -> DataFrame:
    """edges with the value columns of their key; values has (key, columns, n) with the number n of its edges.

    Keys of more than `hot` edges are broadcast, so their edges stay where they
    are; with `hot` a share of all edges these are no more than that share allows.
    The driver asks for these keys' hashes, so that edges are parted by a filter:
    each is joined once, and not at all with the hubs where there are none.
    """
    h = F.xxhash64(*key)
    hubs = [r.h for r in values.where(F.col("n") > hot).select(h.alias("h")).distinct().collect()]
    values = values.drop("n")
    if not hubs:
        return edges.join(values, key)
    rest = edges.where(~h.isin(hubs)).join(values.where(~h.isin(hubs)), key)
    return edges.where(h.isin(hubs)).join(F.broadcast(values.where(h.isin(hubs))), key).unionByName(rest)


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(v, root) for every vertex of edges (a, b): root is the smallest vertex of its component.

    Null ends are dropped, loops count as lone vertices, repeated edges don't
    matter. Every round is two sums by vertex and two joins, and is written to
    the shared folder; the number of rounds grows with the logarithm of the
    number of vertices. Vertices with more than a small share of all edges are
    broadcast, at most four for each shuffle partition; the driver gets only their hashes.
    """
    clean = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(clean, "edges")
    alone = now.where("u = v").select(F.col("u").alias("v"), F.col("u").alias("root"))
    now = now.where("u <> v")
    share = 4 * shuffle_partitions(edges.sparkSession)
    for _ in range(most_rounds):
        up = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = materialize(now.unionByName(up).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"), F.count_if(F.col("v") < F.col("u")).alias("below")), "least")
        # stars: every vertex has one neighbour below it, which has none itself
        seen = least.agg(F.sum("n").alias("n"), F.bool_or(F.expr("below > 1 or (below = 1 and n > 1)")).alias("open")).first()
        if not seen.open:
            break
        hot = seen.n // share + 1
        large = materialize(with_value(up, least.drop("below"), hot, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        lower = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "lower")
        small = with_value(large, lower, hot, ["u"]).select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        now = materialize(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    members = now.select(F.col("u").alias("v"), F.col("v").alias("root"))
    roots = now.select(F.col("v"), F.col("v").alias("root"))
    return members.unionByName(roots).unionByName(alone).groupBy("v").agg(F.min("root").alias("root"))
