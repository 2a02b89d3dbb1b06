"""Near-duplicate vectors: spherical k-means cells, blocked cosines within cells.

Centroids are fitted on a bounded sample; every vector is put in its nearest
`probes` cells. Centroids that lie within linking distance of each other are
merged, so that a group of near copies, however large, meets in one cell. The
number of cells grows with the square root of the number of vectors as far as the
sample allows; cells that are still too large are split by k-means of their own,
again and again, so that the cells' sizes stay bounded where the vectors can be
told apart. A cell of more than `block` vectors is split into blocks that are
compared pairwise, so no task holds more than two blocks, and nothing is left out.
A pair that shares several cells counts in the smallest of them. Blocks give back
link counts and a spanning forest, never their pairs.

Recall: a pair of cosine 0.9 or more is found if its two sets of `probes` cells
meet. On 10,000 random unit vectors of 64 dimensions, each with a partner of cosine
0.9, the hardest case as there are no clusters, 6 probes of 566 cells find 0.9997 of
the pairs, and more probes all (tests/llm measures it). Vectors of different lengths
never link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, lean, materialize, shuffle_partitions, tune
from .components import components, with_value

#: Vectors of a cell that fit its own centroids when it is split; the cells it is split into at most, and at least.
CELL_SAMPLE, CELL_PARTS, LEAST_PARTS = 4096, 64, 16


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their unit vectors in double precision) of a list column, for each length in it.

    Left out: null and empty vectors, zero ones, and those with null or
    non-finite components.
    """
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), 0)
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = column.offsets.to_numpy()[:-1]
    for width in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == width)
        x = flat[first[rows][:, None] + np.arange(width)]
        scale = np.abs(x).max(1)
        good = np.isfinite(x).all(1) & (scale > 0)
        x = x[good] / scale[good][:, None]
        yield rows[good], x / np.sqrt((x * x).sum(1))[:, None]


def fit_cells(x: np.ndarray, k: int, apart: float = 1.0, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """At most k unit centroids of unit vectors by spherical k-means (Dhillon and Modha, 2001).

    Of centroids with a cosine of `apart` or more only the one of the most vectors stays.
    """
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        order = np.argsort(near, kind="stable")
        at, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.sqrt((sums * sums).sum(1))
        c = sums[norm > 1e-9] / norm[norm > 1e-9][:, None]
        if len(c) < k:
            c = np.concatenate([c, x[rng.choice(len(x), k - len(c), replace=False)]])
    near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
    stay: list[int] = []
    alike = c @ c.T >= apart - 1e-12
    for i in np.argsort(-np.bincount(near, minlength=len(c)), kind="stable").tolist():
        if not alike[i, stay].any():
            stay.append(i)
    return c[np.sort(stay)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row connected with each of n rows by the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new[root], root):
            break
        root = new[root]
    return root


def nearest(x: np.ndarray, cells: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the nearest cells of each vector, ascending."""
    probes = min(probes, len(cells))
    return np.sort(np.argpartition(-(x @ cells.T), probes - 1, axis=1)[:, :probes], axis=1).astype(np.int64)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, sample_rows: int = 20_000, probes: int = 6, split: int = 32_768, block: int = 1024) -> DataFrame:
    """(id, n_links, component_id, kept) for each distinct id of `vectors`, and for each row without one.

    Links are pairs of vectors of one length with a cosine of at least `cosine`
    in double precision. Invalid vectors (null, empty, zero, with null or
    non-finite components) link with nothing. Rows that repeat an id count once,
    by one of their valid vectors; rows with a null id link with nothing, have a
    null component and are kept; an empty table gives no rows; other columns are
    ignored. Equal vectors are compared once and counted as often as they occur.
    """
    spark = vectors.sparkSession
    tune(spark)

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x: list[bytes | None] = [None] * len(batch)
            for rows, found in unit_vectors(batch.column(1)):
                for i, v in zip(rows.tolist(), found, strict=True):
                    x[i] = v.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(x, pa.binary())], ["id", "x"])

    one = vectors.where(F.col(id_col).isNotNull()).select(id_col, F.col(vector_col).cast("array<double>")).mapInArrow(lean(unit), "id long, x binary")
    one = materialize(one.groupBy("id").agg(F.max("x").alias("x")), "vectors")
    valid = one.where("x is not null")
    classes = materialize(valid.groupBy(F.sha2("x", 256).alias("key")).agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.octet_length(F.first("x")).alias("size")), "classes")
    reps = valid.join(classes.select(F.col("rep").alias("id"), "copies"), "id")
    widths = {r["size"]: r.n for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, 2 * sample_rows / max(1, sum(widths.values())))
    sample = [r.x for r in reps.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) <= int(share * (1 << 40))).select("id", "x").orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()]
    cells: dict[int, tuple[int, np.ndarray]] = {}  # by bytes of a vector: number of its first cell, centroids
    first = 0
    for size, n in sorted(widths.items()):
        some = [np.frombuffer(x) for x in sample if len(x) == size] or [np.eye(1, size // 8)[0]]
        centroids = fit_cells(np.stack(some), min(round(4 * n**0.5), len(some) // 8), cosine)
        cells[size] = (first, centroids)
        first += len(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offs, data = column_bytes(batch.column(2))
            ids, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sizes = np.diff(offs)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = np.frombuffer(batch.column(2).take(pa.array(at)).buffers()[2], np.float64)[: len(at) * size // 8].reshape(len(at), -1)
                base, centroids = cells[size]
                near = nearest(x, centroids, probes) + base
                r = np.repeat(np.arange(len(at)), near.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel()), pa.array(ids[at][r]), pa.array(copies[at][r]), pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1) * near.shape[1], pa.int32()), pa.array(near[r].ravel())), batch.column(2).take(pa.array(at[r]))], ["cell", "id", "copies", "near", "x"])

    placed = materialize(reps.select("id", "copies", "x").mapInArrow(lean(assign), "cell long, id long, copies long, near array<long>, x binary"), "cells")
    found = materialize(compare_cells(split_cells(placed, cosine, split), cosine, block), "links")
    roots = components(found.where("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = counts.join(roots.withColumnRenamed("v", "id"), "id", "left").select("id", "links", "root")
    keyed = one.select("id", F.sha2("x", 256).alias("key"))
    out = keyed.join(classes, "key", "left").join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "id")
    whole = out.select(F.col("id").alias(id_col), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
    lone = vectors.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return whole.unionByName(lone)


def split_cells(placed: DataFrame, cosine: float, split: int, probes: int = 2, depth: int = 8) -> DataFrame:
    """placed with cells of more than `split` rows split by k-means of their own, as far as they can be.

    Each cell's centroids come from a bounded sample of it. Its rows are dealt
    over tasks, each of which gets the centroids first. Where all centroids of a
    cell lie within linking distance, or so many that less than LEAST_PARTS are
    left, it stays whole: most of it is one group. So do the cells that are left
    after `depth` levels. Each level doubles a cell's rows and divides it by
    LEAST_PARTS at least.
    """

    def fit(table: pa.Table) -> pa.Table:
        sizes = pc.binary_length(table.column("x")).to_numpy()
        x = np.frombuffer(column_bytes(table.column("x").combine_chunks())[1].tobytes(), np.float64).reshape(len(sizes), -1)
        centroids = fit_cells(x, min(CELL_PARTS, len(x) // 8), cosine)
        if len(centroids) < LEAST_PARTS:
            centroids = centroids[:1]
        return pa.table({"cell": pa.array([table.column("cell")[0].as_py()], pa.int64()), "centroids": pa.array([centroids.tobytes()], pa.binary()), "k": pa.array([len(centroids)], pa.int64())})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (cell, salt, id, copies, x) sorted so that a cell's centroids (null id) come first."""
        now, centroids = None, np.zeros((0, 0))
        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            ids = batch.column(2)
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0).any(0)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if not ids[a].is_valid:
                    now, blob = tuple(key[:, a]), batch.column(4)[a].as_py()
                    k = batch.column(3)[a].as_py()
                    centroids = np.frombuffer(blob, np.float64).reshape(k, -1)
                    a += 1
                if a == b:
                    continue
                assert now == tuple(key[:, a])
                x = np.frombuffer(column_bytes(batch.column(4).slice(a, b - a))[1].tobytes(), np.float64).reshape(b - a, -1)
                near = nearest(x, centroids, probes)
                r = np.repeat(np.arange(b - a), near.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), key[0, a])), pa.array(near.ravel()), ids.slice(a, b - a).take(pa.array(r)), batch.column(3).slice(a, b - a).take(pa.array(r)), batch.column(4).slice(a, b - a).take(pa.array(r))], ["cell", "sub", "id", "copies", "x"])

    spark = placed.sparkSession
    share = 4 * shuffle_partitions(spark)
    done, open_ = [], placed.drop("near")
    for _ in range(depth):
        sizes = open_.groupBy("cell").agg(F.count("*").alias("n"))
        sizes = materialize(sizes.withColumn("m", F.col("n")), "sizes")
        total = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        if (total.most or 0) <= split:
            break
        sized = materialize(with_value(open_, sizes, total.n // share + 1, ["cell"]), "sized")
        done.append(sized.where(F.col("m") <= split).drop("m"))
        big = sized.where(F.col("m") > split)
        some = big.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) <= F.least(F.lit(1.0), CELL_SAMPLE / F.col("m")) * F.lit(float(1 << 40)))
        fitted = materialize(some.select("cell", F.col("m").alias("n"), "x").groupBy("cell").applyInArrow(fit, "cell long, centroids binary, k long"), "fitted").join(sizes.select("cell", "n", "m"), "cell")
        whole = with_value(big.drop("m"), fitted.where("k = 1").select("cell", "n"), total.n // share + 1, ["cell"])
        done.append(whole.select("cell", "id", "copies", "x"))
        torn = fitted.where("k > 1")
        salts = F.ceil(F.col("m") / F.lit(16384.0)).cast("long")
        heads = torn.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(None).cast("long").alias("id"), F.col("k").alias("copies"), F.col("centroids").alias("x"))
        rows = with_value(big.drop("m"), torn.select("cell", "n", salts.alias("salts")), total.n // share + 1, ["cell"]).select("cell", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "id", "copies", "x")
        met = rows.unionByName(heads).repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.col("id").isNotNull())
        open_ = materialize(met.mapInArrow(lean(assign), "cell long, sub long, id long, copies long, x binary").select(F.xxhash64("cell", "sub").alias("cell"), "id", "copies", "x"), "split")
    if not done:
        return placed
    for more in done:
        open_ = open_.unionByName(more)
    near = open_.groupBy("id").agg(F.sort_array(F.collect_set("cell")).alias("near"))
    return open_.join(near, "id").select("cell", "id", "copies", "near", "x")


def compare_cells(placed: DataFrame, cosine: float, block: int) -> DataFrame:
    """(id, links, root): link counts and spanning edges from blocks of the cells."""
    sizes = materialize(placed.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"), F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("n").alias("n")).first().n or 0
    parted = with_value(placed, sizes, total // (4 * shuffle_partitions(placed.sparkSession)) + 1, ["cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = dealt.select("cell", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "id", "copies", "near", "x")

    def run(table: pa.Table) -> pa.Table:
        cell, lo, hi = (table.column(c)[0].as_py() for c in ("cell", "lo", "hi"))
        n = table.num_rows
        ids, copies, part = (table.column(c).to_numpy() for c in ("id", "copies", "part"))
        x = np.frombuffer(column_bytes(table.column("x").combine_chunks())[1].tobytes(), np.float64).reshape(n, -1)
        lists = table.column("near").combine_chunks()
        near, owner = lists.flatten().to_numpy(), np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy())
        near, owner = near[near < cell], owner[near < cell]
        below, at = np.unique(near, return_inverse=True)
        flags = np.zeros((n, len(below)), np.float32)
        flags[owner, at] = 1
        left = np.flatnonzero(part == lo)
        right = left if lo == hi else np.flatnonzero(part == hi)
        links, edges = np.zeros(n, np.int64), []
        for k in range(0, len(left), 512):
            rows = left[k : k + 512]
            hit = x[rows] @ x[right].T >= cosine
            if len(below):
                hit &= flags[rows] @ flags[right].T == 0
            if lo == hi:
                hit[np.arange(len(rows)), np.arange(k, k + len(rows))] = False
            links[rows] += hit @ copies[right]
            if lo != hi:
                links[right] += copies[rows] @ hit
            a, b = np.nonzero(hit)
            if len(a):
                edges.append((rows[a], right[b]))
                if len(a) > 100_000:
                    root = forest(n, *map(np.concatenate, zip(*edges, strict=True)))
                    edges = [(np.arange(n), root)]
        a, b = map(np.concatenate, zip(*edges, strict=True)) if edges else (np.zeros(0, int), np.zeros(0, int))
        root = ids[forest(n, a, b)]
        tied = (root != ids) | (links > 0)
        return pa.table({"id": pa.array(ids[tied]), "links": pa.array(links[tied]), "root": pa.array(root[tied])})

    return keyed.groupBy("cell", "lo", "hi").applyInArrow(run, "id long, links long, root long")
