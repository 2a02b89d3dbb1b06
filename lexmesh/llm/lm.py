"""Language-model scoring: corpus counts and a log-bilinear neural model.

Counts of all training tokens are summed by hash over the whole corpus. A
log-bilinear model (Mnih and Hinton, 2007) predicts a token's item, one of the
most frequent words or a class of all others, from the two items before it. A word's
class is made from its last two bytes, so that words that inflect alike share one. It is trained in
numpy by noise-contrastive estimation (Gutmann and Hyvarinen, 2010; Mnih and Teh,
2012) on all training documents: first in the driver on a bounded sample, which is
the start of every task's pass over all tokens of its documents; the tasks' models
are averaged by tokens (McDonald et al., 2010). Batched matrix products then give
the normaliser of every pair of items, so that the probabilities sum to one; a
word within a class has its smoothed share of the class's counts. Scoring is table look-ups.

Frequent words' counts travel with the tasks (a bounded table). Other words go,
packed, to the task that holds their counts, and come back as sums per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SOLID, by_part, column_bytes, crc_mod, dealt, lean, materialize, mix64, parts_for, prefix_hash, slices, span_hash, tune, word_spans

END = np.uint64(0x0123456789ABCDEF)
#: Items of the neural model at least; words whose counts are broadcast; tokens that train the start.
ITEMS, FREQUENT, TRAIN_TOKENS = 512, 1 << 16, 1_500_000
#: One item for so many distinct words, and items at most: the tables have items squared values.
WORDS_PER_ITEM, MOST_ITEMS = 16, 1792
#: Classes of the other words.
CLASSES = 256
SMOOTH = 0.1
#: Noise items that serve a batch.
NOISE = 128

COUNT = np.dtype([("h", "<u8"), ("c", "<u8"), ("k", "<u2")])
ASK = np.dtype([("h", "<u8"), ("d", "<u2")])
SUM = np.dtype([("rid", "<i8"), ("logs", "<f8"), ("known", "<i8")])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the tokens of each row, its end last, one row after another; their classes; row offsets)."""
    low = LOWER[data]
    starts, ends, rows = word_spans(low, offsets, SOLID)
    pre, down = prefix_hash(low)
    h = span_hash(pre, down, starts, ends)
    last = low[ends - 1].astype(np.uint64) * np.uint64(256) + low[np.maximum(ends - 2, starts)]
    k = (mix64(last) % np.uint64(CLASSES)).astype(np.uint16)
    return np.insert(h, rows[1:], END), np.insert(k, rows[1:], 0), rows + np.arange(len(rows))


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        offsets, data = column_bytes(batch.column(at))
        for a, b in slices(offsets):
            yield batch, a, b, *tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def count_tokens(train: DataFrame, parts: int) -> DataFrame:
    """(pid, counts, n_distinct, n_tokens, top, classes): token counts by hash, packed per part.

    top are a part's most frequent tokens, classes the tokens and distinct tokens of each class.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def merged() -> np.ndarray:
            both = np.concatenate(held)
            keys, first, at = np.unique(both["h"], return_index=True, return_inverse=True)
            out = np.zeros(len(keys), COUNT)
            out["h"], out["c"], out["k"] = keys, np.bincount(at, both["c"], len(keys)).astype(np.uint64), both["k"][first]
            return out

        def flush() -> Iterator[pa.RecordBatch]:
            out = merged()
            pid = (mix64(out["h"]) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(pid, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(pid[order])) + 1):
                yield pa.RecordBatch.from_arrays([pa.array([pid[some[0]]], pa.int32()), pa.array([out[some].tobytes()], pa.binary())], ["pid", "blob"])

        for _, _, _, h, k, _ in _texts(batches, 0):
            keys, first, c = np.unique(h, return_index=True, return_counts=True)
            part = np.zeros(len(keys), COUNT)
            part["h"], part["c"], part["k"] = keys, c, k[first]
            held.append(part)
            if sum(map(len, held)) > 2_000_000:
                held[:] = [merged()]
                if len(held[0]) > 1_500_000:
                    yield from flush()
                    held.clear()
        if held:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pid, rows in by_part(batches):
            both = np.concatenate([np.frombuffer(blob, COUNT) for batch in rows for blob in batch.column(1).to_pylist()])
            keys, first, at = np.unique(both["h"], return_index=True, return_inverse=True)
            out = np.zeros(len(keys), COUNT)
            out["h"], out["c"], out["k"] = keys, np.bincount(at, both["c"].astype(float), len(keys)).astype(np.uint64), both["k"][first]
            # hashes deal words evenly, so twice a part's share of the frequent ones is more than it has of them
            top = out[np.lexsort((out["h"], -out["c"].astype(np.int64)))[: 2 * FREQUENT // parts + 1000]]
            words = pa.StructArray.from_arrays([pa.array(top["h"].astype(np.int64)), pa.array(top["c"].astype(np.int64)), pa.array(top["k"].astype(np.int32))], ["h", "c", "k"])
            lists = pa.ListArray.from_arrays(pa.array([0, len(top)], pa.int32()), words)
            by_class = pa.StructArray.from_arrays([pa.array(np.bincount(out["k"], out["c"].astype(float), CLASSES).astype(np.int64)), pa.array(np.bincount(out["k"], minlength=CLASSES))], ["n", "v"])
            classes = pa.ListArray.from_arrays(pa.array([0, CLASSES], pa.int32()), by_class)
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([out.tobytes()], pa.binary()), pa.array([len(out)], pa.int64()), pa.array([int(out["c"].sum())], pa.int64()), lists, classes], ["pid", "counts", "n_distinct", "n_tokens", "top", "classes"])

    return dealt(train.mapInArrow(lean(send), "pid int, blob binary"), parts).mapInArrow(lean(merge), "pid int, counts binary, n_distinct long, n_tokens long, top array<struct<h: long, c: long, k: int>>, classes array<struct<n: long, v: long>>")


@dataclass
class Model:
    """Corpus totals, the frequent words' counts, and the neural tables."""

    total: int
    distinct: int
    keys: np.ndarray  # frequent words' hashes, ascending
    counts: np.ndarray
    item: np.ndarray  # the item of each frequent word; `words` for those that only have their class
    words: int  # items that are words; the classes follow
    first: np.ndarray  # score of (item two before, item)
    second: np.ndarray  # score of (item before, item), with the item's bias
    normaliser: np.ndarray
    whole: np.ndarray  # log10 of what the counts of each class's words are shares of

    @property
    def start(self) -> int:
        """The item that stands before a text."""
        return self.words + CLASSES

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is frequent, place in keys) of hashes."""
        if not len(self.keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return self.keys[at] == h, at

    def items(self, h: np.ndarray, k: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        hit, at = found or self.find(h)
        own = np.where(hit, self.item[at] if len(self.keys) else 0, self.words)
        return np.where(own < self.words, own, self.words + k.astype(np.int64))


def contexts(items: np.ndarray, rows: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Items two before and one before each token; `start` before a row's first."""
    two, one = np.full(len(items), start), np.full(len(items), start)
    one[1:], two[2:] = items[:-1], items[:-2]
    first = rows[:-1]
    one[first] = start
    two[first] = start
    second = first[np.diff(rows) > 1] + 1
    two[second] = start
    return two, one


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each of n places."""
    size = rows.shape[1]
    return np.bincount((at[:, None] * size + np.arange(size)).ravel(), rows.ravel(), n * size).reshape(n, size).astype(rows.dtype)


class Trainer:
    """Noise-contrastive estimation of a log-bilinear model with AdaGrad; params are (words, c_two, c_one, targets, bias).

    noise is the items' distribution, from which k noise items a token are drawn.
    """

    def __init__(self, noise: np.ndarray, size: int = 24, k: int = 12, rate: float = 0.15, seed: int = 11) -> None:
        self.noise, self.k, self.rate, self.rng = noise, k, rate, np.random.default_rng(seed)
        n = len(noise)
        words, targets = self.rng.normal(0, 0.1, (n + 1, size)), self.rng.normal(0, 0.1, (n, size))
        self.params = [words, np.eye(size) * 0.5, np.eye(size), targets, np.log(noise)]
        self.memory = [np.full(p.shape, 1e-2) for p in self.params]
        self.log_noise, self.cumulative = np.log(k * noise), np.cumsum(noise)

    def copy(self, seed: int) -> Trainer:
        """In single precision, with its own random numbers; goes on from here."""
        out = Trainer.__new__(Trainer)
        out.noise, out.k, out.rate, out.rng, out.cumulative = self.noise, self.k, self.rate, np.random.default_rng(seed), self.cumulative
        out.params, out.memory = ([p.astype(np.float32) for p in x] for x in (self.params, self.memory))
        out.log_noise = self.log_noise.astype(np.float32)
        return out

    def learn(self, two: np.ndarray, one: np.ndarray, item: np.ndarray, batch: int = 4096) -> None:
        """One pass over tokens in random order."""
        order = self.rng.permutation(len(item))
        for b in range(0, len(order), batch):
            o = order[b : b + batch]
            self._step(two[o], one[o], item[o])

    def _step(self, two: np.ndarray, one: np.ndarray, item: np.ndarray) -> None:
        words, c2, c1, targets, bias = self.params
        n, m = len(self.noise), len(item)
        r2, r1 = words[two], words[one]
        q = r2 @ c2 + r1 @ c1
        # one set of noise items serves the batch, each weighed k / len(set)
        drawn = np.searchsorted(self.cumulative, self.rng.random(NOISE)).clip(0, n - 1)
        good = (q * targets[item]).sum(1) + bias[item]
        bad = q @ targets[drawn].T + bias[drawn]
        weight = self.k / len(drawn)
        g_good = -1 / (1 + np.exp(np.clip(good - self.log_noise[item], -30, 30)))
        g_bad = weight / (1 + np.exp(np.clip(self.log_noise[drawn] - bad, -30, 30)))
        dq = (g_good[:, None] * targets[item] + g_bad @ targets[drawn]) / m
        dt = _sums(np.concatenate([item, drawn]), np.concatenate([g_good[:, None] * q, g_bad.T @ q]) / m, n)
        db = np.bincount(np.concatenate([item, drawn]), np.concatenate([g_good, g_bad.sum(0)]) / m, n).astype(bias.dtype)
        dw = _sums(np.concatenate([two, one]), np.concatenate([dq @ c2.T, dq @ c1.T]), n + 1)
        for i, grad in enumerate((dw, r2.T @ dq, r1.T @ dq, dt, db)):
            self.memory[i] += grad * grad
            self.params[i] -= self.rate * grad / np.sqrt(self.memory[i])


def train_items(two: np.ndarray, one: np.ndarray, item: np.ndarray, noise: np.ndarray, size: int = 24, k: int = 12, epochs: int = 3, batch: int = 4096, rate: float = 0.15, seed: int = 11) -> tuple[np.ndarray, ...]:
    """(words, c_two, c_one, targets, bias) after some passes over the tokens."""
    trainer = Trainer(noise, size, k, rate, seed)
    for _ in range(epochs):
        trainer.learn(two, one, item, batch)
    return tuple(trainer.params)


def tables(words: np.ndarray, c2: np.ndarray, c1: np.ndarray, targets: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, normaliser) of every pair of items, by batched matrix products."""
    first = ((words @ c2) @ targets.T).astype(np.float32)
    second = ((words @ c1) @ targets.T + bias).astype(np.float32)
    e1, m1 = np.exp(first - first.max(1, keepdims=True)), first.max(1)
    e2, m2 = np.exp(second - second.max(1, keepdims=True)), second.max(1)
    # sum over items of exp(first[a] + second[b]) is a matrix product as well
    return first, second, np.log(np.maximum(e1 @ e2.T, 1e-30)) + m1[:, None] + m2[None, :]


def fit(docs: DataFrame, text_col: str, counts: DataFrame, items: int | None = None, frequent: int = FREQUENT, train_tokens: int = TRAIN_TOKENS, epochs: int = 3) -> Model:
    """Learn from the rows of docs (all of them training rows) with their counted tokens.

    Without a number of items, it grows with the distinct words.
    """
    totals = counts.agg(F.sum("n_tokens").alias("n"), F.sum("n_distinct").alias("v"), F.count("*").alias("parts")).first()
    total, distinct = totals.n or 0, totals.v or 0
    rows = counts.select(F.explode("top").alias("t")).select("t.h", "t.c", "t.k").orderBy(F.desc("c"), "h").limit(frequent).toArrow()
    keys, c, k = rows.column("h").to_numpy().view(np.uint64), rows.column("c").to_numpy(), rows.column("k").to_numpy()
    m = min(items or min(MOST_ITEMS, max(ITEMS, distinct // WORDS_PER_ITEM)), len(keys))
    item = np.full(len(keys), m)
    item[:m] = np.arange(m)
    # what the classes keep when the items are taken out
    by_class = counts.select(F.posexplode("classes").alias("k", "s")).groupBy("k").agg(F.sum("s.n").alias("n"), F.sum("s.v").alias("v")).toArrow()
    left, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    at = by_class.column("k").to_numpy()
    left[at], kinds[at] = by_class.column("n").to_numpy(), by_class.column("v").to_numpy()
    left -= np.bincount(k[:m], c[:m].astype(float), CLASSES)
    kinds -= np.bincount(k[:m], minlength=CLASSES)
    share = np.concatenate([c[:m].astype(float), np.maximum(left, 0) + 0.5])
    order = np.argsort(keys)
    size = m + CLASSES
    known = Model(total, distinct, keys[order], c[order], item[order], m, np.zeros((size + 1, size), np.float32), np.zeros((size + 1, size), np.float32), np.full((size + 1, size + 1), np.log(size)), np.log10(np.maximum(left, 0) + SMOOTH * (np.maximum(kinds, 0) + 1)))
    noise = share / share.sum()
    if not m:
        return known

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, h, k_, at_ in _texts(batches, 0):
            got = known.items(h, k_)
            two, one = contexts(got, at_, known.start)
            yield pa.RecordBatch.from_arrays([pa.array([np.stack([two, one, got]).astype(np.int16).tobytes()], pa.binary())], ["seen"])

    # whole documents, chosen by a hash of the row number, with about train_tokens tokens in all, train the start
    numbered = docs.select(text_col, F.monotonically_increasing_id().alias("_n"))
    picked = F.pmod(F.xxhash64("_n"), F.lit(1 << 40)) <= int(min(1.0, train_tokens / max(1, total)) * (1 << 40))
    packed = numbered.where(picked).select(text_col).mapInArrow(lean(stream), "seen binary").toArrow().column("seen").to_pylist()
    two, one, got = np.concatenate([np.frombuffer(x, np.int16).reshape(3, -1) for x in packed] or [np.zeros((3, 0), np.int16)], axis=1).astype(np.int64)
    trainer = Trainer(noise)
    for _ in range(epochs):
        trainer.learn(two, one, got)
    learned = trainer.params
    if total > train_tokens:
        learned = _train_all(docs.select(text_col), known, trainer)
    known.first, known.second, whole = tables(*learned)
    known.normaliser = whole.astype(np.float32)
    return known


def _train_all(texts: DataFrame, known: Model, start: Trainer, most: int = 1 << 18) -> list[np.ndarray]:
    """The average by tokens of the models that go on from `start`, one a task, over all tokens of all texts."""
    sent = texts.sparkSession.sparkContext.broadcast((known, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, begin = sent.value
        trainer, held, waiting, n = begin.copy(TaskContext.get().partitionId()), [], 0, 0
        for _, _, _, h, k, at in _texts(batches, 0):
            got = model.items(h, k)
            held.append(np.stack([*contexts(got, at, model.start), got]))
            waiting += len(got)
            if waiting >= most:
                trainer.learn(*np.concatenate(held, axis=1))
                n, waiting = n + waiting, 0
                held.clear()
        if waiting:
            trainer.learn(*np.concatenate(held, axis=1))
            n += waiting
        if n:
            flat = np.concatenate([p.ravel() for p in trainer.params])
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["n", "params"])

    total, seen = np.zeros(sum(p.size for p in start.params)), 0
    for row in materialize(texts.mapInArrow(lean(run), "n long, params binary"), "trained").toLocalIterator():
        total += np.frombuffer(row.params, np.float32) * float(row.n)
        seen += row.n
    sent.unpersist()
    cuts = np.cumsum([p.size for p in start.params])[:-1]
    return [x.reshape(p.shape) for x, p in zip(np.split(total / seen, cuts), start.params, strict=True)]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", items: int | None = None, frequent: int = FREQUENT, train_tokens: int = TRAIN_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs.

    Rows with crc32(id) % 10 = 0 are held out, all others train; a null id trains. A
    null or empty text is its end alone. Repeated rows each count and get their
    row; an empty table gives none; without training rows every token is
    unknown. Other columns are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    parts = parts_for(docs)
    held_out = F.coalesce(crc_mod(id_col, 10) == 0, F.lit(False))
    train = docs.where(~held_out)
    counts = materialize(count_tokens(train.select(text_col), parts), "counts")
    model = fit(train, text_col, counts, items, frequent, train_tokens)
    sent = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of documents (rid, id, held_out, sums) and messages (pid, rids, blob)."""
        m, part, row = sent.value, TaskContext.get().partitionId(), 0
        names = ["rid", "id", "held_out", "n_tokens", "n_known", "logs", "logs_other", "neural", "pid", "rids", "blob"]
        kinds = [pa.int64(), None, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
        ask, rids, waiting = [], [], 0

        def flush(id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            h, d = np.concatenate([x[0] for x in ask]), np.concatenate([x[1] for x in ask])
            who = np.concatenate(rids)
            pid = (mix64(h) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(pid, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(pid[order])) + 1):
                docs_, at = np.unique(d[some], return_inverse=True)
                out = np.zeros(len(some), ASK)
                out["h"], out["d"] = h[some], at
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, id_kind if t is None else t) for t in kinds[:8]), pa.array([pid[some[0]]], pa.int32()), pa.array([who[docs_].tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary())], names)
            ask.clear(), rids.clear()
            waiting = 0

        for batch, a, b, h, k, rows in _texts(batches, 2):
            n = b - a
            rid = (part << 33) + row + np.arange(n)
            row += n
            doc = np.repeat(np.arange(n), np.diff(rows))
            hit, at = m.find(h)
            got = m.items(h, k, (hit, at))
            logs = np.where(hit, np.log10((m.counts[at] if len(m.keys) else np.zeros(len(h))) + SMOOTH), 0.0)
            two, one = contexts(got, rows, m.start)
            other = got >= m.words
            neural = (m.first[two, got].astype(float) + m.second[one, got] - m.normaliser[two, one]) / np.log(10) - np.where(other, m.whole[k], 0.0)
            add = lambda x: np.bincount(doc, x, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid), batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(np.diff(rows)), pa.array(add(hit.astype(float)).astype(np.int64)), pa.array(add(logs)), pa.array(add(logs * other)), pa.array(add(neural)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                names,
            )
            if not hit.all():
                ask.append((h[~hit], doc[~hit] + sum(map(len, rids))))
                rids.append(rid)
                waiting += len(ask[-1][0])
                if waiting > 1_000_000 or sum(map(len, rids)) > 50_000:
                    yield from flush(batch.column(0).type)
            id_kind = batch.column(0).type
        if ask:
            yield from flush(id_kind)

    schema = f"rid long, id {kind}, held_out boolean, n_tokens long, n_known long, logs double, logs_other double, neural double, pid int, rids binary, blob binary"
    seen = materialize(docs.select(F.col(id_col), held_out, F.col(text_col)).mapInArrow(lean(look), schema), "looked")

    def sums(held: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(held)
        keys, at = np.unique(both["rid"], return_inverse=True)
        out = np.zeros(len(keys), SUM)
        out["rid"], out["logs"], out["known"] = keys, np.bincount(at, both["logs"], len(keys)), np.bincount(at, both["known"], len(keys))
        return out

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (pid, rids, blob) sorted so that each part's counts (null rids) come first, to messages (to, sums)."""
        now, table, held = None, np.zeros(0, COUNT), []

        def flush() -> Iterator[pa.RecordBatch]:
            out = sums(held)
            held.clear()
            to = (mix64(out["rid"].astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                yield pa.RecordBatch.from_arrays([pa.array([to[some[0]]], pa.int32()), pa.array([out[some].tobytes()], pa.binary())], ["to", "sums"])

        for batch in batches:
            for pid, rids, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if rids is None:
                    now, table = pid, np.frombuffer(blob, COUNT)
                    continue
                r, who = np.frombuffer(blob, ASK), np.frombuffer(rids, np.int64)
                c = np.zeros(len(r))
                if now == pid and len(table):
                    at = np.minimum(np.searchsorted(table["h"], r["h"]), len(table) - 1)
                    c = np.where(table["h"][at] == r["h"], table["c"][at], 0).astype(float)
                part = np.zeros(len(who), SUM)
                d = r["d"].astype(np.int64)
                part["rid"], part["logs"], part["known"] = who, np.bincount(d, np.log10(c + SMOOTH), len(who)), np.bincount(d, c > 0, len(who))
                held.append(part)
            if sum(map(len, held)) > 500_000:
                yield from flush()
        if held:
            yield from flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_part(batches):
            out = sums([np.frombuffer(x, SUM) for batch in rows for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[k])) for k in ("rid", "logs", "known")], ["rid", "more_logs", "more_known"])

    asked = seen.where("blob is not null").select("pid", "rids", "blob").unionByName(counts.select("pid", F.lit(None).cast("binary").alias("rids"), F.col("counts").alias("blob")))
    answers = asked.repartition(parts, "pid").sortWithinPartitions("pid", F.col("rids").isNotNull()).mapInArrow(lean(reply), "to int, sums binary")
    more = dealt(answers, parts, "to").mapInArrow(lean(gather), "rid long, more_logs double, more_known long")
    n, v = model.total, model.distinct
    whole = float(np.log10(n + SMOOTH * (v + 1)))
    extra = F.coalesce("more_logs", F.lit(0.0))
    return (
        seen.where("blob is null")
        .join(more, "rid", "left")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("logs") + extra - F.col("n_tokens") * whole).alias("base_score"),
            (F.col("neural") + F.col("logs_other") + extra).alias("score"),
        )
    )
