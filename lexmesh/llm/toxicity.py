"""Toxicity by maximum-scoring segments of token log-odds.

Learning: in a bounded sample of labelled rows, the document frequencies of
words and of their first 4, 5 and 6 bytes (so that unseen endings of a known
stem count) give log-odds with an informative Dirichlet prior and their
z-scores (Monroe, Colaresi and Quinn, 2008). Features that are significantly
toxic are kept; all other tokens share one small negative score.

Scoring: every maximal scoring segment of a text is found in one scan (Ruzzo and
Tompa, 1999). Scores of the best segment follow an extreme-value law in clean
texts (Karlin and Altschul, 1990), whose rate and location are fitted, which makes
them comparable between texts of any length; all segments of a text are taken
together by the law of their sums. A logistic curve over the surprise gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, column_bytes, crc_mod, labelled_sample, lean, materialize, prefix_hash, slices, span_hash, tune, word_spans

STEMS = (4, 5, 6)
#: Documents that the Dirichlet prior of a feature is worth, spread by its frequency.
PRIOR = 10.0
#: The chance in clean text up to which a segment is a passage of its own.
SIGNIFICANT = 0.01
#: Different words before a feature that are enough, however often it occurs.
CONTEXTS = 32


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word and of its stems; a word that is no longer than a stem has 0 there."""
    pre, down = prefix_hash(data)
    out = [span_hash(pre, down, starts, ends)]
    for n in STEMS:
        long = ends - starts > n
        h = np.zeros(len(starts), np.uint64)
        h[long] = span_hash(pre, down, starts[long], starts[long] + n) ^ np.uint64(n)
        out.append(h)
    return out


@dataclass
class Model:
    """Sorted feature hashes with their scores, the score of other tokens, and the calibration."""

    keys: np.ndarray
    scores: np.ndarray
    other: float = -0.02
    rate: float = 1.0  # of the extreme-value law
    log_k: float = 0.0
    weights: tuple[float, float] = (-4.0, 1.0)

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def of(self, hashes: list[np.ndarray]) -> np.ndarray:
        """The best score of each token's features; 0 where none is known."""
        best = np.zeros(len(hashes[0]))
        if len(self.keys):
            for h in hashes:
                maybe = np.flatnonzero(self.filter[(h >> np.uint64(48)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                hit = self.keys[at] == h[maybe]
                np.maximum.at(best, maybe[hit], self.scores[at[hit]])
        return best

    def excess(self, scores: np.ndarray, n: float) -> np.ndarray:
        """Scores of segments on the scale of the extreme-value law, for a text of n tokens."""
        return self.rate * np.asarray(scores, float) - math.log(n + 1.0) - self.log_k

    def surprise(self, scores: list[float], n: float) -> float:
        """-log of the chance that a clean text of n tokens has segments with these scores.

        The best segment alone has the extreme-value law's chance. The r best
        together are judged by the sum of their excess T (Karlin and Altschul, 1993):
        exp(-T) T^(r-1) / (r! (r-1)!); each further segment costs a factor 2, as r is
        chosen to make the text most surprising.
        """
        if not len(scores):
            return 0.0
        x = np.sort(self.excess(scores, n))[::-1]
        best = float(x[0]) if x[0] > 30 else -math.log(max(-math.expm1(-math.exp(-float(x[0]))), 1e-300))
        total = float(x[0])
        for r, more in enumerate(x[1:].tolist(), 2):
            if more <= 0:
                break
            total += more
            if total > r:  # where the tail is a tail
                best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2))
        return best

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        a, b = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * np.minimum(surprise, 60), -50, 50)))


def segments(at: np.ndarray, scores: np.ndarray, other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, one past the last, score) of a text.

    at and scores are the positions and scores of its positive tokens; all other
    tokens score `other` (negative). Linear in the positive tokens.
    """
    found: list[list[float]] = []  # first, last + 1, sum before, sum after
    total, done = 0.0, 0
    for p, s in zip(at.tolist(), scores.tolist(), strict=True):
        total += (p - done) * other
        new = [p, p + 1, total, total + s]
        total, done = total + s, p + 1
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                found.append(new)
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            del found[k:]
    return [(int(a), int(b), r - left) for a, b, left, r in found]


def _documents(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(batch, first row, last row, first word of each row, features, starts, ends) by slices of rows."""
    for batch in batches:
        offsets, data = column_bytes(batch.column(text))
        for a, b in slices(offsets):
            part = LOWER[data[offsets[a] : offsets[b]]]
            starts, ends, rows = word_spans(part, offsets[a : b + 1] - offsets[a], ALNUM)
            yield batch, a, b, rows, _features(part, starts, ends), starts, ends


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, z: float = 3.0, least_odds: float = 2.0) -> Model:
    """A model from `sample_rows` labelled rows at most, none with crc32(doc_id) % 5 = 0.

    Rows whose id or label is null teach nothing, nor do ids with both labels.
    Without rows of both classes, or without a feature that tells them apart, nothing is toxic.
    """
    spark = docs.sparkSession
    some = labelled_sample(labels.where(crc_mod("doc_id", 5) != 0), "toxic", sample_rows)
    tune(spark)
    # equal texts count once, so that a copied text weighs no more than another
    train = materialize(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("toxic", "text").dropDuplicates(), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, y1, y0 = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, at = np.unique(h, return_inverse=True)
            return keys, np.bincount(at, y1, len(keys)).astype(np.int64), np.bincount(at, y0, len(keys)).astype(np.int64)

        for batch, a, b, rows, features, _, _ in _documents(batches, 1):
            toxic = batch.column(0).to_numpy(zero_copy_only=False)[a:b]
            doc = np.repeat(np.arange(b - a), np.diff(rows))
            for h in features:
                order = np.lexsort((h, doc))
                first = np.ones(len(h), bool)
                first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                pick = order[first]
                pick = pick[h[pick] != 0]
                y = toxic[doc[pick]]
                held.append((h[pick], (y == 1).astype(np.int64), (y == 0).astype(np.int64)))
            if sum(len(x[0]) for x in held) > 2_000_000:
                held[:] = [merged()]
        if held:
            keys, y1, y0 = merged()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(y1), pa.array(y0)], ["h", "y1", "y0"])

    classes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    counts = train.mapInArrow(lean(count), "h long, y1 long, y0 long").groupBy("h").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    prior = PRIOR * (F.col("y1") + F.col("y0")) / F.lit(float(n1 + n0)) + 0.5
    odds = lambda y, n: F.log((F.col(y) + prior) / (F.lit(float(n) + PRIOR + 1.0) - F.col(y) - prior))
    scored = counts.where("y1 > 2").withColumn("score", odds("y1", n1) - odds("y0", n0)).withColumn("z", F.col("score") / F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior)))
    top = scored.where((F.col("z") > z) & (F.col("score") > least_odds)).select("h", "score").toPandas()  # of a bounded sample
    keys, odds_of = _diverse(train, top["h"].to_numpy(np.int64).view(np.uint64), top["score"].to_numpy(float))
    order = np.argsort(keys)
    model = Model(keys[order], odds_of[order])
    if not len(keys):
        return model
    model.rate = _rate(train.where("toxic = 0").select("text"), model)
    got = _best(train, model, ["toxic"]).select("toxic", "found", "n").toPandas()
    y, n = got["toxic"].to_numpy(int), got["n"].to_numpy(float)
    best = np.array([max(x, default=0.0) for x in got["found"]])
    clean = (y == 0) & (best > 0)
    if clean.sum() >= 20:  # the law's location, by moments
        model.log_k = float((model.rate * best[clean] - np.log(n[clean] + 1)).mean()) - 0.5772
    _calibrate(model, np.array([model.surprise(x, m) for x, m in zip(got["found"], n, strict=True)]), y)
    return model


def _rate(texts: DataFrame, model: Model, step: float = 0.05) -> float:
    """The law's rate: lambda > 0 with E[exp(lambda * score)] = 1 over the tokens of clean texts (Karlin and Altschul, 1990).

    1, the rate of exact log-odds, if no clean token scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, features, starts, _ in _documents(batches, 0):
            s = model.of(features)
            bins, n = np.unique(np.round(s[s > 0] / step).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(bins, 0)), pa.array(np.append(n, len(starts) - n.sum()).astype(np.int64))], ["bin", "n"])

    got = texts.mapInArrow(lean(run), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    score, n = np.where(got["bin"] > 0, got["bin"] * step, model.other), got["n"].to_numpy(float)
    if not (score > 0).any() or (score * n).sum() >= 0:
        return 1.0
    moment = lambda rate: float((n * np.expm1(rate * score)).sum())
    low, high = 0.0, 1.0
    while moment(high) < 0:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 0 else (low, mid)
    return high


def _diverse(train: DataFrame, keys: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features whose toxic occurrences follow many different words.

    Near copies of one toxic text repeat its harmless words as well, but always in
    the same places; a toxic word comes after any word. As different words run out
    in large samples, CONTEXTS of them are enough.
    """
    order = np.argsort(keys)
    keys, scores = keys[order], scores[order]
    look = Model(keys, np.ones(len(keys)))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, rows, features, _, _ in _documents(batches, 1):
            toxic = batch.column(0).to_numpy(zero_copy_only=False)[a:b]
            doc = np.repeat(np.arange(b - a), np.diff(rows))
            word = features[0]
            before = np.concatenate([[np.uint64(0)], word[:-1]]) if len(word) else word
            for h in features:
                maybe = np.flatnonzero(look.filter[(h >> np.uint64(48)).astype(np.int64)])
                if len(keys) and len(maybe):
                    at = np.minimum(np.searchsorted(keys, h[maybe]), len(keys) - 1)
                    pick = maybe[(keys[at] == h[maybe]) & (toxic[doc[maybe]] == 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(h[pick].view(np.int64)), pa.array(before[pick].view(np.int64))], ["h", "before"])

    got = train.mapInArrow(lean(contexts), "h long, before long").groupBy("h", "before").agg(F.count("*").alias("n")).groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).where((F.col("kinds") >= 3) & ((2 * F.col("kinds") >= F.col("n")) | (F.col("kinds") >= CONTEXTS))).select("h").toPandas()
    keep = np.isin(keys, got["h"].to_numpy(np.int64).view(np.uint64))
    return keys[keep], scores[keep]


def _calibrate(model: Model, surprise: np.ndarray, y: np.ndarray) -> None:
    """A ridge logistic curve over the surprise, moved so that its middle makes the fewest errors."""
    x = np.minimum(surprise, 60)
    w = np.array([-2.0, 0.5])
    design = np.stack([np.ones(len(x)), x], 1)
    ridge = np.diag([1e-3, 1e-3]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - ridge @ w
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    if w[1] > 1e-6:  # a flat curve would give every text the middle, which is toxic
        model.weights = (float(-w[1] * _cut(x, y)), float(w[1]))


def _cut(x: np.ndarray, y: np.ndarray) -> float:
    """The value that parts y = 0 from y = 1 with the fewest errors, the highest among equals: in doubt a text is clean."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + (y == 0).sum() - np.concatenate([[0], np.cumsum(y == 0)])
    free = np.concatenate([[False], x[1:] > x[:-1], [True]])  # a cut can't part equal values
    at = np.flatnonzero(free)
    best = int(at[len(at) - 1 - np.argmin(errors[at][::-1])])
    return float((x[best - 1] + x[best]) / 2) if best < len(x) else float(x[-1] + 1)


def _best(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", with_text: bool = False) -> DataFrame:
    """keep, n (tokens), found (scores of all maximal segments), score, passages and, if asked for, the text of each row."""
    tune(docs.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(keep)
        for batch, a, b, rows, features, _, _ in _documents(batches, at):
            s = model.of(features)
            n = np.diff(rows)
            surprise, passages, every = np.zeros(b - a), [[] for _ in range(b - a)], [[] for _ in range(b - a)]
            hot = np.flatnonzero(s)
            edges = np.searchsorted(hot, rows)
            for doc in np.flatnonzero(np.diff(edges)).tolist():
                mine = hot[edges[doc] : edges[doc + 1]]
                found = segments(mine - rows[doc], s[mine], model.other)
                every[doc] = [x[2] for x in found]
                surprise[doc] = model.surprise(every[doc], float(n[doc]))
                for first, last, score in found:
                    chance = math.exp(-min(700.0, model.surprise([score], float(n[doc]))))
                    if chance <= SIGNIFICANT:
                        passages[doc].append({"first_word": first, "last_word": last - 1, "score": score, "chance": chance})
            kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]))
            cols = [batch.column(i).slice(a, b - a) for i in range(at)]
            text = [batch.column(at).slice(a, b - a)] * with_text
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n), pa.array(every, pa.list_(pa.float64())), pa.array(model.probability(surprise)), pa.array(passages, kind), *text], [*keep, "n", "found", "score", "passages", *["_scored"] * with_text])

    schema = f"{kinds}, n long, found array<double>, score double, passages array<struct<first_word: long, last_word: long, score: double, chance: double>>" + ", _scored string" * with_text
    return docs.select(*keep, F.col(text_col).alias("_scored")).mapInArrow(lean(run), schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted, passages) for each row of docs.

    A null or empty text has no tokens and gets the lowest score. A null id is
    not held out. Repeated rows each get their row; an empty table gives none;
    other columns are ignored. passages are the segments whose chance in clean
    text is at most SIGNIFICANT; the score takes all segments together.
    """
    out = _best(docs, model, [id_col], text_col)
    return out.select(id_col, F.coalesce(crc_mod(id_col, 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def passing(rows: DataFrame, model: Model, *keep: str, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """The columns `keep` (and the text, if asked for) of the rows whose text is not predicted to be toxic."""
    left = _best(rows, model, list(keep), text_col, with_text).where("score < 0.5")
    return left.select(*keep, *[F.col("_scored").alias(text_col)] * with_text)
