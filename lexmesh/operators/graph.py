"""Graphs as node and edge tables, and their metrics.

Sums by vertex and by edge are plain aggregates. Metrics over all shortest paths
are at least n times m work: they run source by source in Arrow functions over
a broadcast edge list. Beyond MOST_EDGES edges distances are joins, and
betweenness and communities refuse the graph.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmesh.functions import text as T
from lexmesh.session import cut

#: Edges that a shortest-path metric broadcasts at most.
MOST_EDGES = 2_000_000
#: Sources of one breadth-first search, a bit each.
TOGETHER = 64


def nodes(entities: DataFrame, entity: str = "entity", kind: str = "type", layer: str = "layer", position: str = "pos") -> DataFrame:
    """(nid, label, type, layer, layers, frequency) of entity mentions in the order of `position`.

    The label is the last seen, the type the most frequent (the first seen wins
    ties), the layer the first seen.
    """
    rows = entities.select(T.node_id(F.col(entity)).alias("nid"), F.col(entity).alias("label"), F.col(kind).alias("type"), F.col(layer).alias("layer"), F.col(position).alias("pos")).where("nid <> ''")
    kinds = rows.groupBy("nid", "type").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    modal = kinds.groupBy("nid").agg(F.max_by("type", F.struct("n", (-F.col("first")).alias("o"))).alias("type"))
    base = rows.groupBy("nid").agg(F.max_by("label", "pos").alias("label"), F.min_by("layer", "pos").alias("layer"), F.array_sort(F.collect_set("layer")).alias("layers"), F.count("*").alias("frequency"))
    return base.join(modal, "nid").select("nid", "label", "type", "layer", "layers", "frequency")


def cooccurrence(entities: DataFrame, section: tuple[str, ...], entity: str = "entity") -> DataFrame:
    """(src, dst, weight): unordered pairs of entities and the sections that have both.

    A section's distinct entities come together once, and its pairs are made from
    that row, so there is no self-join.
    """
    sets = entities.select(*section, T.node_id(F.col(entity)).alias("nid")).where("nid <> ''").groupBy(*section).agg(F.array_sort(F.collect_set("nid")).alias("ids")).where("size(ids) > 1")
    return pairs(sets, "ids").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def pairs(sets: DataFrame, ids: str, *keep: str) -> DataFrame:
    """(keep, src, dst): pairs of a sorted array, src before dst."""
    one = sets.select(*keep, ids, F.posexplode(ids).alias("i", "src"))
    return one.select(*keep, "src", F.explode(F.slice(ids, F.col("i") + 2, F.size(ids))).alias("dst"))


def edges(entities: DataFrame, job: str, section: str, entity: str = "entity", layer: str = "layer") -> DataFrame:
    """(src, dst, weight, layers, n_documents, transversal)."""
    rows = entities.select(F.col(job).alias("job"), F.col(section).alias("section"), T.node_id(F.col(entity)).alias("nid"), F.col(layer).alias("layer")).where("nid <> ''")
    sets = rows.groupBy("job", "section").agg(F.array_sort(F.collect_set("nid")).alias("ids"), F.collect_set("layer").alias("layers")).where("size(ids) > 1")
    # summed per pair and layer, so that what is merged are counts and not lists
    found = pairs(sets, "ids", "job", "layers").groupBy("src", "dst", "job", "layers").agg(F.count("*").alias("w"))
    out = found.groupBy("src", "dst").agg(F.sum("w").alias("weight"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("layers")))).alias("layers"), F.count_distinct("job").alias("n_documents"))
    return out.withColumn("transversal", F.size("layers") > 1)


def degree_centrality(links: DataFrame) -> DataFrame:
    """(node, degree, centrality) of an undirected graph (src, dst)."""
    ends = links.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    n = ends.agg(F.count("*").alias("n"))
    return ends.crossJoin(F.broadcast(n)).select("node", "degree", F.round(F.col("degree") / F.greatest(F.col("n") - 1, F.lit(1)), 4).alias("centrality"))


def directed_degree(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """(node, in_degree, out_degree, centrality) of all vertices (node)."""
    ends = links.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e")).select("e.*")
    sums = ends.groupBy("node").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    n = vertices.agg(F.count("*").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return vertices.join(sums, "node", "left").crossJoin(F.broadcast(n)).select("node", zero("in_degree").alias("in_degree"), zero("out_degree").alias("out_degree"), F.round((zero("in_degree") + zero("out_degree")) / F.greatest(F.col("n") - 1, F.lit(1)), 4).alias("centrality"))


def density(links: DataFrame, vertices: DataFrame, directed: bool = False) -> DataFrame:
    """(n_nodes, n_edges, density), one row."""
    n, m = vertices.agg(F.count("*").alias("n_nodes")), links.agg(F.count("*").alias("n_edges"))
    one = n.crossJoin(m)
    value = F.when(F.col("n_nodes") > 1, (1 if directed else 2) * F.col("n_edges") / (F.col("n_nodes") * (F.col("n_nodes") - 1))).otherwise(F.lit(0.0))
    return one.select("n_nodes", "n_edges", F.round(value.cast("double"), 6).alias("density"))


def density_by_layer(links: DataFrame, layered: DataFrame) -> DataFrame:
    """(layer, n_nodes, n_edges, density): induced subgraphs of the nodes (nid, layer) of each layer; null below 2 nodes."""
    n = layered.groupBy("layer").agg(F.count("*").alias("n_nodes"))
    a, b = layered.select(F.col("nid").alias("src"), "layer"), layered.select(F.col("nid").alias("dst"), "layer")
    m = links.select("src", "dst").join(a, "src").join(b, ["dst", "layer"]).groupBy("layer").agg(F.count("*").alias("n_edges"))
    k = F.col("n_nodes")
    return n.join(m, "layer", "left").select("layer", "n_nodes", F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"), F.round(F.when(k > 1, 2 * F.coalesce("n_edges", F.lit(0)) / (k * (k - 1))).cast("double"), 4).alias("density"))


def weak_components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component): the smallest node that links reach, by minimum labels with pointer jumping.

    Each round is written by checkpoint(), so its plan stays small; labels that
    have not settled after `rounds` rounds are an error, never a result.
    """
    both = cut(links.select("src", "dst").union(links.select(F.col("dst"), F.col("src"))).toDF("node", "other").distinct())
    label = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component"))
    before = None
    for _ in range(rounds):
        near = both.join(label.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("c"))
        low = label.join(near, "node").select("node", F.least("component", "c").alias("component"))
        jump = low.select(F.col("node").alias("component"), F.col("component").alias("up"))
        label = cut(low.join(jump, "component", "left").select("node", F.coalesce("up", "component").alias("component")))
        now = label.agg(F.sum(F.xxhash64("node", "component").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return label
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def distances(links: DataFrame, sources: DataFrame | None = None, directed: bool = False) -> DataFrame:
    """(source, target, distance) of all reachable pairs, source itself at 0, breadth-first.

    The edges are broadcast, and each task sends the pairs of its sources as it
    finds them; none is shuffled or kept. With given sources, or beyond MOST_EDGES
    edges, every round joins the frontier of all sources with the edges and keeps
    what is new, until nothing is; the rounds' frontiers are written and put
    together at the end. The result has a row per pair; `path_sums` needs no pairs.
    """
    if sources is None and links.count() <= MOST_EDGES:
        kind = links.schema["src"].dataType

        def run(graph: _Packed, names: pa.Array, block: np.ndarray) -> Iterator[pa.RecordBatch]:
            for d, front in _levels(graph, block):
                at = np.flatnonzero(front)
                for some in np.array_split(at, len(at) // 8192 + 1):
                    row, k = np.nonzero(_bits(front[some]))
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(block[k])), names.take(pa.array(some[row])), pa.array(np.full(len(row), d, np.int32))], ["source", "target", "distance"])

        return _by_block(links, _packed(links, directed, reverse=True), run, f"source {kind.simpleString()}, target {kind.simpleString()}, distance int")
    e = links.select("src", "dst") if directed else links.select("src", "dst").union(links.select("dst", "src")).distinct()
    e = cut(e)
    start = sources.select(F.col(sources.columns[0]).alias("source")) if sources is not None else links.select(F.explode(F.array("src", "dst")).alias("source")).distinct()
    seen = cut(start.select("source", F.col("source").alias("target"), F.lit(0).alias("distance")))
    rounds = [seen]
    while rounds[-1].limit(1).count():
        frontier = rounds[-1]
        step = frontier.join(e, frontier.target == e.src).select("source", F.col("dst").alias("target")).distinct()
        # a step can't come back to more than two rounds before, but for directed links
        old = reduce(DataFrame.unionByName, rounds if directed else rounds[-2:]).select("source", "target")
        rounds.append(cut(step.join(old, ["source", "target"], "left_anti").withColumn("distance", F.lit(len(rounds)))))
    return reduce(DataFrame.unionByName, rounds)


class _Packed:
    """A graph as arrays: neighbours of vertex v are to[first[v] : first[v + 1]]."""

    def __init__(self, names: np.ndarray, first: np.ndarray, to: np.ndarray, cost: np.ndarray) -> None:
        self.names, self.first, self.to, self.cost = names, first, to, cost

    def out(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vertex of the level, neighbour) for every edge that leaves the level."""
        n = self.first[level + 1] - self.first[level]
        at = np.repeat(self.first[level] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(level, n), self.to[at]


def _packed(links: DataFrame, directed: bool, weight: str | None = None, inverse: bool = False, reverse: bool = False) -> _Packed:
    """The edge list, on the driver; more than MOST_EDGES edges are an error."""
    if (m := links.count()) > MOST_EDGES:
        raise ValueError(f"{m} edges; metrics over all shortest paths take {MOST_EDGES} at most")
    got = links.select("src", "dst", *[weight] * bool(weight)).toPandas()
    names = np.unique(np.concatenate([got["src"].to_numpy(), got["dst"].to_numpy()])) if len(got) else np.array([])
    a, b = np.searchsorted(names, got["src"].to_numpy()), np.searchsorted(names, got["dst"].to_numpy())
    length = got[weight].to_numpy(float) if weight else np.ones(len(got))
    if inverse:
        length = 1 / length
    if reverse:
        a, b = b, a
    if not directed:
        a, b, length = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([length, length])
    order = np.lexsort((length, b, a))
    a, b, length = a[order], b[order], length[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])  # of parallel edges the shortest
    a, b, length = a[first], b[first], length[first]
    return _Packed(names, np.searchsorted(a, np.arange(len(names) + 1)), b, length)


def _levels(graph: _Packed, sources: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(distance, vertices as bits of the sources) of at most TOGETHER searches: along the links from each vertex to the source."""
    some = np.flatnonzero(np.diff(graph.first))
    seen = np.zeros(len(graph.names), np.uint64)
    seen[sources] = np.uint64(1) << np.arange(len(sources), dtype=np.uint64)
    front, d = seen.copy(), 0
    while front.any():
        yield d, front
        near = np.zeros_like(front)
        if len(some):
            near[some] = np.bitwise_or.reduceat(front[graph.to], graph.first[some])
        front, d = near & ~seen, d + 1
        seen |= front


def _bits(front: np.ndarray) -> np.ndarray:
    """A row of TOGETHER zeros and ones for each vertex."""
    return np.unpackbits(front.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _by_block(links: DataFrame, graph: _Packed, run: Callable[[_Packed, pa.Array, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What `run` gives for blocks of TOGETHER vertices, with the vertices' names."""
    spark, n = links.sparkSession, len(graph.names)
    sent = spark.sparkContext.broadcast(graph)
    kind = to_arrow_type(links.schema["src"].dataType)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(sent.value.names.tolist(), kind)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                yield from run(sent.value, names, np.arange(b * TOGETHER, min(n, (b + 1) * TOGETHER)))

    count = -(-n // TOGETHER)
    tasks = max(1, min(count, spark.sparkContext.defaultParallelism * 4))
    return spark.range(0, count, 1, tasks).mapInArrow(blocks, schema)


def path_sums(links: DataFrame, directed: bool = False) -> DataFrame:
    """(node, total, reach, far): sum, number and largest of the distances above 0 to each vertex from those that reach it.

    The edges are broadcast and tasks send back one row per vertex, so no pair is
    ever a row; beyond MOST_EDGES edges the sums are taken of joined pairs.
    """
    if links.count() > MOST_EDGES:
        found = distances(links, directed=directed)
        away = F.col("distance") > 0
        return found.groupBy(F.col("target").alias("node")).agg(F.sum("distance").cast("long").alias("total"), F.count_if(away).alias("reach"), F.max("distance").cast("long").alias("far"))

    def run(graph: _Packed, names: pa.Array, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        total, reach, far = np.zeros((3, len(block)), np.int64)
        for d, front in _levels(graph, block):
            if d:
                n = np.zeros(len(block), np.int64)
                for some in np.array_split(front[front != 0], len(front) // 65536 + 1):
                    n += _bits(some).sum(0, dtype=np.int64)[: len(block)]
                total, reach, far = total + d * n, reach + n, np.where(n > 0, d, far)
        yield pa.RecordBatch.from_arrays([names.take(pa.array(block)), pa.array(total), pa.array(reach), pa.array(far)], ["node", "total", "reach", "far"])

    return _by_block(links, _packed(links, directed), run, f"node {links.schema['src'].dataType.simpleString()}, total long, reach long, far long")


def _by_source(links: DataFrame, graph: _Packed, work: Callable[[_Packed, int], tuple[np.ndarray, np.ndarray]], schema: str, share: float = 1.0) -> DataFrame:
    """Rows (i, value) that `work` gives for each source, or for a share of them, summed per task."""
    spark, n = links.sparkSession, len(graph.names)
    sent = spark.sparkContext.broadcast(graph)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                at, value = work(sent.value, s)
                total[at] += value
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["i", "value"])

    picked = spark.range(n).select(F.col("id").alias("s"))
    if share < 1:
        picked = picked.where(F.pmod(F.xxhash64("s"), F.lit(1 << 20)) < int(share * (1 << 20)))
    tasks = max(1, min(n, spark.sparkContext.defaultParallelism * 2))
    sums = picked.repartition(tasks, "s").mapInArrow(run, schema).groupBy("i").agg(F.sum("value").alias("value"))
    kind = links.schema["src"].dataType.simpleString()
    table = spark.createDataFrame([(i, x.item() if hasattr(x, "item") else x) for i, x in enumerate(graph.names)], f"i long, node {kind}")
    return table.join(sums, "i", "left").select("node", F.coalesce("value", F.lit(0.0)).alias("value"))


def closeness_centrality(links: DataFrame, vertices: DataFrame, directed: bool = False) -> DataFrame:
    """(node, closeness) of all vertices (node), as `closeness` gives it, without the pairs."""
    found = path_sums(links, directed)
    n = vertices.agg(F.count("*").alias("n"))
    value = F.when(F.col("total") > 0, (F.col("reach") / F.col("total")) * (F.col("reach") / F.greatest(F.col("n") - 1, F.lit(1)))).otherwise(F.lit(0.0))
    return vertices.join(found, "node", "left").crossJoin(F.broadcast(n)).select("node", F.round(value, 6).alias("closeness"))


def closeness(found: DataFrame, vertices: DataFrame) -> DataFrame:
    """(node, closeness): incoming distances, scaled by the share of vertices that reach the node."""
    n = vertices.agg(F.count("*").alias("n"))
    by = found.where("distance > 0").groupBy(F.col("target").alias("node")).agg(F.sum("distance").alias("total"), F.count("*").alias("reach"))
    value = F.when(F.col("total") > 0, (F.col("reach") / F.col("total")) * (F.col("reach") / (F.col("n") - 1))).otherwise(F.lit(0.0))
    return vertices.join(by, "node", "left").crossJoin(F.broadcast(n)).select("node", F.round(F.coalesce(value, F.lit(0.0)), 6).alias("closeness"))


def path_summary(found: DataFrame, vertices: DataFrame) -> DataFrame:
    """(diameter, mean_geodesic) of `distances`: over ordered pairs; null unless all vertices reach each other."""
    one = found.where("distance > 0").agg(F.sum("distance").alias("total"), F.count("*").alias("reach"), F.max("distance").alias("far"))
    return sums_summary(one, vertices)


def sums_summary(sums: DataFrame, vertices: DataFrame) -> DataFrame:
    """The same of `path_sums`."""
    n = vertices.agg(F.count("*").alias("n"))
    one = sums.agg(F.max("far").cast("long").alias("d"), F.sum("total").alias("total"), F.sum("reach").alias("pairs")).crossJoin(n)
    whole = (F.col("pairs") > 0) & (F.col("pairs") == F.col("n") * (F.col("n") - 1))
    return one.select(F.when(whole, F.col("d")).alias("diameter"), F.when(whole, F.round(F.col("total") / F.col("pairs"), 4)).alias("mean_geodesic"))


def betweenness(links: DataFrame, directed: bool = False, weight: str | None = None, inverse: bool = False, sources: float = 1.0) -> DataFrame:
    """(node, betweenness), normalised, endpoints excluded (Brandes, 2001).

    The edge list is broadcast (at most MOST_EDGES edges; more is an error), and
    the sources are spread over the tasks, which send back sums per node. With a
    weight, it is the length of an edge (or 1 / weight with inverse). sources
    below 1 takes that share of the sources and scales (Brandes and Pich, 2007).
    """
    graph = _packed(links, directed, weight, inverse)
    n = len(graph.names)
    found = _by_source(links, graph, _dependencies if weight is None else _weighted_dependencies, "i long, value double", sources)
    scale = (1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0) / sources
    return found.select("node", F.round(F.col("value") * scale, 6).alias("betweenness"))


def _dependencies(graph: _Packed, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Brandes' dependencies of source s on every vertex: levels forth, then back."""
    n = len(graph.names)
    dist, paths, steps = np.full(n, -1), np.zeros(n), []
    dist[s], paths[s] = 0, 1
    level, d = np.array([s]), 0
    while len(level):
        a, b = graph.out(level)
        level = np.unique(b[dist[b] < 0])
        d += 1
        dist[level] = d
        tight = dist[b] == d
        a, b = a[tight], b[tight]
        paths += np.bincount(b, paths[a], n)
        steps.append((a, b))
    out = np.zeros(n)
    for a, b in reversed(steps):
        out += np.bincount(a, paths[a] / paths[b] * (1 + out[b]), n)
    out[s] = 0
    at = np.flatnonzero(out)
    return at, out[at]


def _weighted_dependencies(graph: _Packed, s: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for lengths above 0: distances nearest first, then paths over the tight edges once all before are counted."""
    n = len(graph.names)
    dist, wait = np.full(n, np.inf), np.array([s])
    dist[s], span = 0, graph.cost.mean() if len(graph.cost) else 0
    while len(wait):
        now = dist[wait] <= dist[wait].min() + span  # of any span: who gets nearer later on waits again
        level, wait = wait[now], wait[~now]
        k = graph.first[level + 1] - graph.first[level]
        at = np.repeat(graph.first[level] - np.cumsum(k) + k, k) + np.arange(k.sum())
        to, far = graph.to[at], np.repeat(dist[level], k) + graph.cost[at]
        nearer = far < dist[to] - 1e-12
        np.minimum.at(dist, to[nearer], far[nearer])
        wait = np.unique(np.concatenate([wait, to[nearer]]))
    reached = np.isfinite(dist)
    src = np.repeat(np.arange(n), np.diff(graph.first))
    tight = np.flatnonzero(reached[src])
    tight = tight[np.abs(dist[src[tight]] + graph.cost[tight] - dist[graph.to[tight]]) <= 1e-12]
    tree = _Packed(graph.names, np.searchsorted(src[tight], np.arange(n + 1)), graph.to[tight], graph.cost[tight])
    missing, paths, steps, level = np.bincount(tree.to, minlength=n), np.zeros(n), [], np.array([s])
    paths[s] = 1
    while len(level):
        a, b = tree.out(level)
        np.add.at(paths, b, paths[a])
        np.subtract.at(missing, b, 1)
        steps.append((a, b))
        level = np.unique(b)
        level = level[missing[level] == 0]
    out = np.zeros(n)
    for a, b in reversed(steps):
        np.add.at(out, a, paths[a] / paths[b] * (1 + out[b]))
    out[s] = 0
    at = np.flatnonzero(out)
    return at, out[at]


def communities(links: DataFrame, weight: str = "weight") -> DataFrame:
    """(node, community): Louvain moves and folds in a fixed order (Blondel et al., 2008), in one task.

    Sequential by nature; takes at most MOST_EDGES edges. Communities are
    numbered by their smallest node.
    """
    if (m := links.count()) > MOST_EDGES:
        raise ValueError(f"{m} edges; communities takes {MOST_EDGES} at most")
    kind = links.schema["src"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        src, dst, w = (table.column(c).to_pylist() for c in ("src", "dst", "weight"))
        names = sorted({*src, *dst})
        at = {x: i for i, x in enumerate(names)}
        near: list[dict[int, float]] = [{} for _ in names]
        for a, b, c in zip(src, dst, w, strict=True):
            i, j = at[a], at[b]
            near[i][j] = near[i].get(j, 0.0) + c
            if i != j:
                near[j][i] = near[j].get(i, 0.0) + c
        member = list(range(len(names)))
        while True:
            where, moved = _louvain_level(near)
            if not moved:
                break
            ids = {c: k for k, c in enumerate(sorted(set(where)))}
            member = [ids[where[m_]] for m_ in member]
            folded: list[dict[int, float]] = [{} for _ in ids]
            for i, row in enumerate(near):
                for j, c in row.items():
                    a, b = ids[where[i]], ids[where[j]]
                    if a == b:
                        folded[a][a] = folded[a].get(a, 0.0) + (c if i == j else c / 2)
                    else:
                        folded[a][b] = folded[a].get(b, 0.0) + c
            near = folded
        label: dict[int, int] = {}
        for m_ in member:
            label.setdefault(m_, len(label))
        return pa.table({"node": pa.array(names, table.schema.field("src").type), "community": pa.array([label[m_] for m_ in member], pa.int64())})

    one = links.select(F.lit(0).alias("g"), "src", "dst", F.col(weight).cast("double").alias("weight"))
    return one.groupBy("g").applyInArrow(run, f"node {kind}, community long")


def _louvain_level(near: list[dict[int, float]]) -> tuple[list[int], bool]:
    where = list(range(len(near)))
    strength = [sum(row.values()) + row.get(i, 0.0) for i, row in enumerate(near)]
    total, mass = sum(strength), strength[:]
    moved_any = False
    while total > 0:
        moved = False
        for i, row in enumerate(near):
            links: dict[int, float] = {}
            for j, c in row.items():
                if j != i:
                    links[where[j]] = links.get(where[j], 0.0) + c
            old = where[i]
            mass[old] -= strength[i]
            gain = lambda c, links=links, i=i: links.get(c, 0.0) - strength[i] * mass[c] / total
            best = max(sorted({*links, old}), key=lambda c: (gain(c), c == old))
            if gain(best) <= gain(old) + 1e-12:
                best = old
            mass[best] += strength[i]
            if best != old:
                where[i], moved = best, True
        moved_any |= moved
        if not moved:
            break
    return where, moved_any


def modularity(links: DataFrame, parts: DataFrame, weight: str = "weight") -> DataFrame:
    """(modularity), one row (Newman, 2004), of undirected edges (src, dst, weight) and (node, community)."""
    a = parts.select(F.col("node").alias("src"), F.col("community").alias("ca"))
    b = parts.select(F.col("node").alias("dst"), F.col("community").alias("cb"))
    e = links.select("src", "dst", F.col(weight).cast("double").alias("w")).join(a, "src").join(b, "dst")
    inside = e.groupBy(F.when(F.col("ca") == F.col("cb"), F.col("ca")).alias("c")).agg(F.sum("w").alias("w_in")).where("c is not null")
    ends = e.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), "w"), F.struct(F.col("cb").alias("c"), "w"))).alias("x")).select("x.*").groupBy("c").agg(F.sum("w").alias("k"))
    m = e.agg(F.sum("w").alias("m"))
    return ends.join(inside, "c", "left").crossJoin(F.broadcast(m)).agg(F.round(F.sum(F.coalesce("w_in", F.lit(0.0)) / F.col("m") - F.pow(F.col("k") / (2 * F.col("m")), F.lit(2.0))), 4).alias("modularity"))


def adjacency(links: DataFrame, vertices: list, weight: str = "weight", order: str = "id") -> DataFrame:
    """One row per source with a column per vertex; of repeated edges the first by `order` counts, 0 elsewhere."""
    best = links.groupBy("src", "dst").agg(F.min_by(weight, order).alias("w"))
    return best.groupBy("src").pivot("dst", vertices).agg(F.first("w")).fillna(0)


def incidence(links: DataFrame, memberships: DataFrame, actors: DataFrame, stages: list[str]) -> DataFrame:
    """(actor, one X column per stage, n_stages): stages of an actor's edges (either end) and of its memberships."""
    ends = links.select(F.explode(F.array("src", "dst")).alias("actor"), "stage")
    both = ends.union(memberships.select("actor", "stage")).distinct().join(actors.select("actor"), "actor", "left_semi")
    return both.groupBy("actor").agg(*(F.max(F.when(F.col("stage") == s, F.lit("X")).otherwise("")).alias(s) for s in stages), F.count_distinct("stage").alias("n_stages"))


def last_edges(links: DataFrame, order: str = "id") -> DataFrame:
    """Of repeated edges, the one that comes last."""
    w = Window.partitionBy("src", "dst").orderBy(F.desc(order))
    return links.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def scaling(metrics: DataFrame) -> DataFrame:
    """Adds node_size (200 + 3000 b)."""
    return metrics.withColumn("node_size", F.round(200 + 3000 * F.col("betweenness"), 2))
