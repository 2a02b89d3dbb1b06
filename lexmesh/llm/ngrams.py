"""N-gram Jaccard join by chosen paths (Christiani, Pagh and Sivertsen, 2018).

Texts become sets of hashed 5-word shingles; equal sets are one class. Each set
is embedded in 64 min-wise samples. A run starts with all sets in one node and
splits it: a node samples two of the 64 coordinates, and a set goes to the child
of each of its two values, so sets that share a sampled shingle stay together.
Two sets of similarity 0.8 share a child with probability 0.96, and at least one
leaf of a run with probability 0.93 however deep the tree gets; the number of
runs follows from the recall that is asked for.

* A node of one set is dropped; in a node of at most `small` sets all pairs are
  compared (by their 64 samples), and a spanning forest of the links goes on.
* In a larger node all sets are compared with one pivot. Sets near the pivot
  are linked with it; those so near that their partners are as a rule linked with
  the pivot too (Jaccard distance is a metric) leave the node, and the others are
  split further. So a large group of near copies costs one comparison a set.

The links found so are candidates. They only say which sets must meet: within a
component of candidates all pairs of sets are compared exactly, shingle by
shingle, in blocks of bounded size, which give back link counts and a spanning
forest but never their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, binary_array, column_bytes, lean, materialize, mix64, prefix_hash, shuffle_partitions, slices, span_hash, tune, word_spans
from .components import components, with_value
from .embeddings import forest

WORDS = 5
SIMILARITY = 0.8
SAMPLES = 64
SPLITS = 2
SMALL = 256
BLOCK = 512
DEPTH = 12
#: Similarity estimates: pairs of small nodes above PAIR are candidates; a pivot links what is above LINK and
#: releases what is above LEAVE. LOST is the share of pairs that a run may lose so: one leaves, and the other,
#: on the far side of the pivot, is not linked. Each node of each run has its own pivot, so runs lose others.
PAIR, LINK, LEAVE, LOST = 0.6, 0.45, 0.5, 0.1

_rng = np.random.default_rng(20180401)
_A = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_C = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def runs_for(recall: float, similarity: float = SIMILARITY, splits: int = SPLITS) -> int:
    """Runs after which a pair of this similarity has met in a leaf with probability `recall`."""
    q = 1.0
    for _ in range(200):  # the chance to share a leaf of an endless tree
        q = 1 - (1 - similarity * q) ** splits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - q * (1 - LOST))))


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashed shingles of each row, ascending, one row after another; row offsets).

    Words are runs of letters and digits, A-Z lower-cased. A text of fewer than
    `words` words is one shingle; a text without words has none.
    """
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, ALNUM)
    pre, down = prefix_hash(data)
    w = span_hash(pre, down, starts, ends)
    n = np.diff(rows)
    width = np.minimum(n, words)
    count = np.where(n > 0, n - width + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(rows[:-1], count) + np.arange(first[-1]) - np.repeat(first[:-1], count)
    size = np.repeat(width, count)
    h = np.zeros(len(at), np.uint64)
    for k in range(words):
        more = size > k
        if more.all():
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[at + k]
        else:
            h[more] = h[more] * np.uint64(0x9E3779B97F4A7C15) + w[at[more] + k]
    h = mix64(h)
    parts = [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else h, np.concatenate([[0], np.cumsum(sizes)])


def samples(sets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Min-wise samples (rows x SAMPLES) of non-empty sets."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(rows) - 1, SAMPLES), np.uint32)
    for k in range(SAMPLES):
        v = x * _A[k] + _B[k]
        v ^= v >> np.uint32(15)
        v *= _C[k]
        out[:, k] = np.minimum.reduceat(v, rows[:-1])
    return out


def children(node: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Ids (rows x SPLITS) of the children of each row's node that its samples choose."""
    out = np.empty((len(node), SPLITS), np.uint64)
    at = mix64(node) % np.uint64(SAMPLES)
    step = mix64(node + np.uint64(1)) % np.uint64(SAMPLES - 1) + np.uint64(1)
    for k in range(SPLITS):
        value = sig[np.arange(len(node)), at.astype(np.int64)].astype(np.uint64)
        out[:, k] = mix64(mix64(node * np.uint64(31) + at) + value)
        at = (at + step) % np.uint64(SAMPLES)
    return out


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column_bytes(column)[1].tobytes(), np.uint32).reshape(-1, SAMPLES)


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, runs: int) -> DataFrame:
    """(id, th, k1, k2, n, sig, nodes): each text's set hash, size, samples and first-level nodes."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = column_bytes(batch.column(2))
            for a, b in slices(offsets):
                sets, rows = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                n = np.diff(rows)
                full = np.flatnonzero(n)
                keys = np.zeros((2, b - a), np.uint64)
                sig = np.zeros((b - a, SAMPLES), np.uint32)
                nodes = np.zeros((b - a, runs * SPLITS), np.uint64)
                if len(full):
                    at = np.concatenate([rows[full], rows[-1:]])
                    keys[0, full] = np.add.reduceat(mix64(sets), at[:-1])
                    keys[1, full] = np.add.reduceat(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), at[:-1])
                    sig[full] = samples(sets, at)
                    for r in range(runs):
                        root = np.full(len(full), 1 + r, np.uint64)
                        nodes[full, r * SPLITS : (r + 1) * SPLITS] = children(mix64(root), sig[full])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * nodes.shape[1], nodes.shape[1]), pa.int32()), pa.array(nodes.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(n), binary_array(np.arange(b - a + 1) * SAMPLES, sig.ravel()), lists],
                    ["id", "th", "k1", "k2", "n", "sig", "nodes"],
                )

    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col))
    return base.mapInArrow(lean(run), "id long, th long, k1 long, k2 long, n long, sig binary, nodes array<long>")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links of small nodes; rows (node, doc, sig) come sorted by node."""
    node, doc, sig = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, SAMPLES), np.uint32)

    def compare(node: np.ndarray, doc: np.ndarray, sig: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        for d in range(1, len(node)):
            i = np.flatnonzero(node[:-d] == node[d:])
            if not len(i):
                break
            i = i[(sig[i] == sig[i + d]).mean(1) >= PAIR]
            found.append(np.stack([i, i + d]))
        if found and sum(x.shape[1] for x in found):
            # candidates only say what belongs together: a spanning forest says it with fewer links than rows
            root = forest(len(node), *np.concatenate(found, 1))
            a, b = doc, doc[root]
            a, b = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)])[:, a != b], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        node, doc, sig = np.concatenate([node, batch.column(0).to_numpy()]), np.concatenate([doc, batch.column(1).to_numpy()]), np.concatenate([sig, _sigs(batch.column(2))])
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0  # the last node may go on
        yield from compare(node[:cut], doc[:cut], sig[:cut])
        node, doc, sig = node[cut:], doc[cut:], sig[cut:]
    yield from compare(node, doc, sig)


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, doc, sig, pivot, psig) of large nodes to (doc, sig, pivot if near, children if it stays)."""
    for batch in batches:
        if not len(batch):
            continue
        node, sig = batch.column(0).to_numpy().view(np.uint64), _sigs(batch.column(2))
        alike = (sig == _sigs(batch.column(4))).mean(1)
        stays = alike < LEAVE
        next_ = children(node, sig)[stays]
        offs = np.concatenate([[0], np.cumsum(np.where(stays, SPLITS, 0))])
        lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(np.ascontiguousarray(next_).ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(batch.column(3).to_numpy(), mask=alike < LINK), lists], ["doc", "sig", "pivot", "next"])


def candidates(reps: DataFrame, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Candidate links (a, b) between the sets (doc, sig, nodes)."""
    spark = reps.sparkSession
    sigs = reps.select("doc", "sig")
    rows = reps.select("doc", F.explode("nodes").alias("node"))  # later levels have sig as well
    edges, small_nodes = spark.createDataFrame([], "a long, b long"), []
    share = 4 * shuffle_partitions(spark)
    for level in range(depth + 1):
        sizes = materialize(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").withColumn("n", F.col("size")), "sizes")
        seen = sizes.agg(F.sum("size").alias("n"), F.max("size").alias("most")).first()
        hot = (seen.n or 0) // share + 1
        live = materialize(with_value(rows, sizes, hot, ["node"]), "nodes")
        small_, big = live.where(F.col("size") <= small), live.where(F.col("size") > small)
        leaves = small_.drop("size")
        if level == depth:  # what is still together is compared in blocks of a small node's size
            parts = big.withColumn("parts", F.ceil(2 * F.col("size") / small).cast("int")).withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
            dealt = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            leaves = leaves.unionByName(dealt.withColumn("node", F.xxhash64("node", F.least("part", "other"), F.greatest("part", "other"))).select(*leaves.columns))
        if level == 0:
            leaves = leaves.join(sigs, "doc")
        small_nodes.append(leaves.select("node", "doc", "sig"))
        if level == depth or (seen.most or 0) <= small:
            break
        pivots = big.groupBy("node").agg(F.min(F.struct(F.xxhash64("node", "doc").alias("h"), "doc")).alias("p"), F.count("*").alias("n")).select("node", F.col("p.doc").alias("pivot"), "n")
        if level == 0:
            pivots = pivots.join(sigs.select(F.col("doc").alias("pivot"), F.col("sig").alias("psig")), "pivot")
            big = big.join(sigs, "doc")
        else:
            pivots = pivots.join(big.select("node", F.col("doc").alias("pivot"), F.col("sig").alias("psig")), ["node", "pivot"])
        met = with_value(big, materialize(pivots.select("node", "pivot", "psig", "n"), "pivots"), hot, ["node"]).select("node", "doc", "sig", "pivot", "psig")
        split = materialize(met.mapInArrow(lean(_pivots), "doc long, sig binary, pivot long, next array<long>"), "split")
        edges = edges.unionByName(split.where("pivot is not null and pivot <> doc").select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
        rows = split.where("size(next) > 0").select("doc", "sig", F.explode("next").alias("node"))
    # the small nodes of all levels are compared in one pass
    near = reduce(DataFrame.unionByName, small_nodes).repartition("node").sortWithinPartitions("node").mapInArrow(lean(_pairs), "a long, b long")
    return edges.unionByName(near)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    token = np.cumsum(new) - 1
    shared = (np.bincount(token) > 1)[token]
    token, owner = token[shared], owner[shared]
    _, token = np.unique(token, return_inverse=True)
    out = np.zeros((m, m), np.float32)
    wide = max(1, 4_000_000 // m)
    cuts = np.searchsorted(token, np.arange(0, (token[-1] if len(token) else 0) + wide + 1, wide))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            hit = np.zeros((m, wide), np.float32)
            hit[owner[a:b], token[a:b] % wide] = 1
            out += hit @ hit.T
    return out


def _verify(similarity: float, words: int):
    def group(ids: np.ndarray, copies: np.ndarray, part: np.ndarray, lo: int, hi: int, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(s) for s in sets])
        if len(ids) == 2:
            inter = np.array([[0, 1], [1, 0]]) * len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        else:
            inter = _common(sets)
        hit = inter >= similarity * (n[:, None] + n[None, :] - inter) - 1e-9
        hit &= ids[:, None] != ids[None, :]
        if lo != hi:
            hit &= part[:, None] != part[None, :]
        links = hit @ copies
        root = ids[forest(len(ids), *np.nonzero(hit))]
        # ids need not be ascending: the smallest id of each tree is its root
        trees, at = np.unique(root, return_inverse=True)
        low = np.full(len(trees), np.iinfo(np.int64).max)
        np.minimum.at(low, at, ids)
        return ids, links, low[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (root, lo, hi, part, doc, copies, text) sorted by (root, lo, hi)."""
        held: list[pa.RecordBatch] = []

        def emit(table: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            keys = np.stack([table.column(c).to_numpy() for c in range(3)], 1).astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
            stops = np.concatenate([new, [len(keys)]])
            if not last:
                stops = stops[:-1]
            out = []
            if len(stops) > 1:
                upto = int(stops[-1])
                part, doc, copies = (table.column(c).to_numpy()[:upto] for c in (3, 4, 5))
                offsets, data = column_bytes(table.column(6).slice(0, upto).combine_chunks())
                sets: list[np.ndarray] = []
                for a, b in slices(offsets):
                    flat, rows = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                    sets += [flat[rows[i] : rows[i + 1]] for i in range(b - a)]
                for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True):
                    if b - a > 1:
                        cols = group(doc[a:b], copies[a:b], part[a:b], keys[a, 1], keys[a, 2], sets[a:b])
                        out.append(pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["doc", "links", "root"]))
                table = table.slice(upto)
            return out, table

        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(len(x) for x in held) >= 2000:
                out, rest = emit(pa.Table.from_batches(held), False)
                held = rest.to_batches()
                if out:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if held:
            out, _ = emit(pa.Table.from_batches(held), True)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return run


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, recall: float = 0.999, small: int = SMALL, block: int = BLOCK, with_hash: bool = False) -> DataFrame:
    """(id, class_id, n_links, kept): one row per distinct (id, text) of docs.

    n_links is the number of other documents whose shingle sets have at least
    this Jaccard similarity; class_id is the smallest id that links reach; kept
    is true for the document with that id. A text of fewer than `words` words is
    one shingle of all its words; a null or empty text, or one without words,
    links with nothing. Equal texts under different ids link; rows that repeat
    an id and its text are one row. Rows with a null id come back with a null class, no links and kept.
    An empty table gives none; other columns are ignored.
    """
    runs = runs_for(recall, similarity)
    sketch = materialize(sketches(docs, id_col, text_col, words, runs).dropDuplicates(["id", "th"]), "sketches")
    filled = sketch.where("n > 0")
    classes = materialize(filled.groupBy("k1", "k2", "n").agg(F.min(F.struct("id", "th")).alias("r"), F.count("*").alias("copies")).select("k1", "k2", "n", "r.id", "r.th", "copies"), "classes")
    reps = materialize(filled.select("id", "th", "sig", "nodes").join(classes.select("id", "th"), ["id", "th"]).select(F.col("id").alias("doc"), "sig", "nodes"), "sets")
    found = components(candidates(reps, small))
    sizes = found.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    member = found.join(sizes, "root").select(F.col("v").alias("id"), "root", "parts").join(classes.select("id", "th", "copies"), "id")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    # a row that repeats another would be a second copy of it in its block
    met = member.join(texts, ["id", "th"]).dropDuplicates(["id", "th"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = met.select("root", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", F.col("id").alias("doc"), "copies", "text")
    dealt = keyed.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
    checked = materialize(dealt.mapInArrow(lean(_verify(similarity, words)), "doc long, links long, root long"), "checked")
    roots = components(checked.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    linked = checked.groupBy("doc").agg(F.sum("links").alias("links")).join(roots.select(F.col("v").alias("doc"), F.col("root").alias("top")), "doc", "left")
    by_class = classes.select("k1", "k2", "n", "id", "copies").join(linked, classes.id == linked.doc, "left").select("k1", "k2", "n", F.coalesce("top", "id").alias("top"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = sketch.select("id", "th", "k1", "k2", "n").join(by_class, ["k1", "k2", "n"], "left")
    whole = out.select(F.col("id").alias(id_col), F.coalesce("top", "id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), (F.coalesce("top", "id") == F.col("id")).alias("kept"), *[F.col("th")] * with_hash)
    lone = docs.where(F.col(id_col).isNull()).select(F.col(id_col).cast("long").alias(id_col), F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), *[F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th")] * with_hash)
    return whole.unionByName(lone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that jaccard_join keeps, each once, with all their columns; null ids stay."""
    kept = jaccard_join(docs, id_col, text_col, with_hash=True).where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col("th").alias("_th"))
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"))
    some = row.where("_id is not null").join(kept, ["_id", "_th"]).dropDuplicates(["_id", "_th"])
    return some.select("_row.*").unionByName(row.where("_id is null").select("_row.*"))
