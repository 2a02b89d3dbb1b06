"""SentencePiece encoding and decoding with a shared-prefix forward pass.

Marked words (a word with the marks that stand for the spaces before it) are
encoded once per shard: no piece of the vocabulary joins across a mark that
follows a word, so a text's ids are those of its words, one after another. The
distinct words are sorted, which makes them a trie in depth-first order; the
forward pass visits every trie node once, and words reuse the values of the
prefixes they share. A text without spaces is one long word like any other.

For a unigram model a node's forward value is the largest sum of scores (Viterbi)
and its last piece. For a byte-pair model sums of scores don't give the encoding
that merging gives; there the value is the last piece of the prefix's encoding: a
prefix ends in piece t after a prefix that ends in s if and only if merging s and
t's characters leaves the two apart, which is one pair test, and exactly one t
passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ragged, tune

MARK = "▁"
#: Bytes of text that are encoded together.
SHARD_BYTES = 8 << 20
GAP = "\x00"


class Vocabulary:
    """Pieces with scores, and the tests of a byte-pair model.

    pieces and scores by id; byte_ids gives the id of each byte value; `merges`
    says that the model is byte-pair (its scores are then merge priorities).
    """

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool], byte_ids: list[int], merges: bool) -> None:
        self.pieces, self.merges = pieces, merges
        self.scores = np.array(scores)
        self.byte_ids = np.array(byte_ids, np.int64)
        ids = [i for i, ok in enumerate(normal) if ok]
        self.index = {pieces[i]: i for i in ids}
        self.sizes = np.array([len(p) for p in pieces])
        # lengths of the pieces that end in three characters, longest first, so that few strings are looked up in vain
        ends: dict[str, set[int]] = {}
        for p in self.index:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {k: (*sorted(v, reverse=True), 2, 1) for k, v in ends.items()}
        # rank: the order in which merges happen; single characters come before all
        best = sorted(ids, key=lambda i: (-scores[i], i))
        self.rank = np.zeros(len(pieces), np.int64)
        self.rank[best] = np.arange(1, len(best) + 1)
        self.left = self.right = np.arange(len(pieces))
        self.whole = np.ones(len(pieces), bool)
        if merges:
            self._split()
        raw = [bytes([byte_ids.index(i)]) if i in set(byte_ids) else (p.replace(MARK, " ").encode() if ok else b"") for i, (p, ok) in enumerate(zip(pieces, normal, strict=True))]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    def merge(self, text: str) -> list[int]:
        """Ids of a short text by merging the best pair again and again (reference for the pair test)."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.index.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.rank[i] < self.rank[best]):
                    best, at = i, k
            if best is None:
                return [self.index.get(p, -1) for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _split(self) -> None:
        """The two pieces that merge into each piece, and whether merging its characters gives it."""
        self.left, self.right = np.arange(len(self.pieces)), np.arange(len(self.pieces))
        for p, i in self.index.items():
            if len(p) == 1:
                continue
            parts = list(p)
            while len(parts) > 2:
                options = [(self.rank[j], k) for k in range(len(parts) - 1) if (j := self.index.get(parts[k] + parts[k + 1])) is not None]
                if not options:
                    break
                _, k = min(options)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 2 and parts[0] in self.index and parts[1] in self.index:
                self.left[i], self.right[i] = self.index[parts[0]], self.index[parts[1]]
            else:
                self.whole[i] = False
        pairs = {}
        for p, i in self.index.items():
            for k in range(1, len(p)):
                a, b = self.index.get(p[:k]), self.index.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * len(self.pieces) + b] = i
        rank = self.rank.tolist()
        self.pairs = {k: rank[i] for k, i in pairs.items()}
        self.halves = self.left.tolist(), self.right.tolist(), rank
        self.known: dict[int, bool] = {}

    def apart(self, a: int, b: int) -> bool:
        """Whether pieces a and b, side by side, stay as they are under merging.

        The merges that made a's end and b's start are undone, latest first: none
        may lose to a merge across the border.
        """
        key = a * len(self.pieces) + b
        if (known := self.known.get(key)) is not None:
            return known
        left, right, rank = self.halves
        n, limit, ok = len(self.pieces), 1 << 62, True
        while True:
            across = self.pairs.get(a * n + b)
            if across is not None and across < limit:
                ok = False
                break
            x, y = right[a], left[b]
            if x == a and y == b:
                break
            rx, ry = rank[a] if x != a else -1, rank[b] if y != b else -1
            if rx > ry:  # the later merge is undone first; of equals the right one came later
                a, limit = x, rx
            else:
                b, limit = y, ry + 1
        if len(self.known) > 2_000_000:
            self.known.clear()
        self.known[key] = ok
        return ok


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file.

    A model whose scores are 0, -1, -2 ... in the order of its pieces is byte-pair.
    """
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    normal = [not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in range(n)]
    byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    scores = [m.get_score(i) for i in range(n)]
    merges = all(float(s).is_integer() for s, ok in zip(scores, normal, strict=True) if ok)
    return Vocabulary([m.id_to_piece(i) for i in range(n)], scores, normal, byte_ids, merges)


def encode_words(words: list[str], voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, one after another; number of ids of each): words are sorted and distinct.

    Sorted words are the trie in depth-first order. `last` and `total` hold the
    forward values along the path to the present node; going on to the next word
    drops those below the prefix that both share, and no node is computed twice.
    """
    index, whole, ends_of, merges, scores, byte_ids = voc.index, voc.whole.tolist(), voc.ends, voc.merges, voc.scores.tolist(), voc.byte_ids.tolist()
    apart, known, count = voc.apart, getattr(voc, "known", {}), len(voc.pieces)
    sizes, byte_score = voc.sizes.tolist(), float(voc.scores.min()) - 10.0
    last, total, before = [-1], [0.0], ""
    flat: list[int] = []
    ends = [0]
    for w in words:
        d = _shared(before, w)
        del last[d + 1 :], total[d + 1 :]
        for e in range(d + 1, len(w) + 1):
            value = -1  # the bytes of one character
            lengths = ends_of.get(w[e - 3 : e], (2, 1)) if e > 2 else (2, 1)
            if merges:
                for m in lengths:
                    if m > e or (t := index.get(w[e - m : e])) is None or not whole[t]:
                        continue
                    s = last[e - m]
                    if m == e or s < 0:
                        value = t
                        break
                    if (ok := known.get(s * count + t)) is None:
                        ok = apart(s, t)
                    if ok:
                        value = t
                        break
            else:
                best = total[e - 1] + byte_score
                for m in reversed(lengths):
                    if m <= e and (t := index.get(w[e - m : e])) is not None and (m == 1 or total[e - m] + scores[t] > best):
                        best, value = total[e - m] + scores[t], t
                total.append(best)
            last.append(value)
        # back from the end of the word
        at, ids = len(w), []
        while at:
            t = last[at]
            if t >= 0:
                ids.append(t)
                at -= sizes[t]
            else:
                at -= 1
                ids += [byte_ids[x] for x in reversed(w[at].encode("utf-8", "replace"))]
        flat += reversed(ids)
        ends.append(len(flat))
        before = w
    return np.array(flat, np.int32), np.diff(np.array(ends, np.int64))


def _shared(a: str, b: str) -> int:
    """Length of the prefix that both have."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # equal up to low, not up to high
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def encode_texts(texts: pa.Array, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, one after another; number of ids of each); null or empty texts have none."""
    texts = texts.fill_null("").cast(pa.large_string())
    marked = pc.replace_substring(texts, MARK, " ")
    empty = pc.equal(pc.binary_length(marked), 0).to_numpy(zero_copy_only=False)
    marked = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), marked, pa.scalar("", pa.large_string()))
    has_gap = pc.any(pc.match_substring(marked, GAP)).as_py()
    if has_gap:  # the separator occurs in a text: cut those texts by hand
        import re

        lists = pa.array([re.findall(r" *[^ ]+| +$", t) for t in marked.to_pylist()], pa.list_(pa.large_string()))
    else:
        lists = pc.split_pattern(pc.replace_substring_regex(marked, "([^ ]) ", "\\1" + GAP + " "), GAP)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary
    order = pc.sort_indices(distinct).to_numpy()
    words = [w.replace(" ", MARK) for w in distinct.take(pa.array(order)).to_pylist()]
    flat, sizes = encode_words(words, voc)
    start = np.cumsum(sizes) - sizes
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    at = place[coded.indices.to_numpy()]
    rows = lists.offsets.to_numpy()[: len(lists) + 1]
    counts = np.concatenate([[0], np.cumsum(sizes[at])])[rows - rows[0]]
    ids, n = ragged(flat, start[at], sizes[at]), np.diff(counts)
    if empty.any():
        keep = ~np.repeat(empty, n)
        ids, n = ids[keep], np.where(empty, 0, n)
    return ids, n


def decode_texts(ids: np.ndarray, n: np.ndarray, voc: Vocabulary) -> pa.Array:
    """The texts that the ids stand for; bytes that are no UTF-8 become U+FFFD."""
    data = ragged(voc.raw, voc.raw_start[ids], voc.raw_size[ids])
    sizes = voc.raw_size[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)])]
    first = ends[:-1] + ((n > 0) & (data[np.minimum(ends[:-1], max(0, len(data) - 1))] == 32) if len(data) else 0)
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends[1:] - first)]).astype(np.int64)), pa.py_buffer(ragged(data, first, ends[1:] - first))])
    try:
        return raw.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.large_string())


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, round_trip) for each row of docs; round_trip: decoding gives the text again.

    A null or empty text has no ids. A null id stays null; repeated rows each get
    their row; an empty table gives none; other columns are ignored. Texts of any
    length are encoded whole.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = load(model_path)
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            texts = table.column(1).combine_chunks().fill_null("").cast(pa.large_string())
            ids, n = encode_texts(texts, voc)
            same = pc.equal(pc.replace_substring(texts, MARK, " "), decode_texts(ids, n, voc))
            rows = np.concatenate([[0], np.cumsum(n)])
            for i in range(0, len(n), 2000):
                j = min(i + 2000, len(n))
                lists = pa.ListArray.from_arrays(pa.array(rows[i : j + 1] - rows[i], pa.int32()), pa.array(ids[rows[i] : rows[j]]))
                yield pa.RecordBatch.from_arrays([table.column(0).combine_chunks().slice(i, j - i), pa.array(n[i:j]), lists, same.slice(i, j - i)], [id_col, "n_tokens", "ids", "round_trip"])

        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(x.nbytes for x in held) >= SHARD_BYTES:
                yield from flush()
        yield from flush()

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {kind}, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for each row; null or empty ids give the empty text."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = load(model_path)
        for batch in batches:
            lists = batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            ids = lists.flatten().to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), decode_texts(ids, n, voc).cast(pa.string())], [id_col, "text"])

    return encoded.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(lean(run), f"`{id_col}` {kind}, text string")
