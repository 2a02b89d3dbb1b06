"""Packing documents into fixed windows by non-negative least squares.

A window is best filled by a few whole remainders, so the lengths are put in
buckets, every combination of up to three buckets that fills a window becomes a
column, and non-negative least squares says how often to use each of them to
use up the histogram. The counts are rounded down, the documents that are left
are packed greedily by best fit, and what still does not fit is cut to close
the gaps. The last window of a shard is cut at powers of two, so nothing is
padded.

Every task packs the documents of its own input split, in shards of a bounded
number of ids: there is no shuffle, nothing is sent to the driver, and a lost
task gives the same windows when it runs again.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import give_back, lean, ragged, tune

WINDOW = 2048
END_ID = 1
#: Bytes of text that are encoded and packed together; bounds a task's memory.
SHARD_BYTES = 8 << 20
#: Words whose ids a worker keeps from shard to shard.
KNOWN = 250_000
#: Width of a length bucket.
STEP = 32
SEPARATOR = "~"
#: Fixed value: the tokenizer's own pre-tokenisation, for lower-cased words.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of these characters are in normal form, and lower-case alike everywhere.
PLAIN = r"\A[\x21-\x7D\x{C0}-\x{FF}]+\z"


class WordEncoder:
    """Ids of whole texts through the ids of their distinct words.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its space-separated words, one after another; and those of a
    plain word are those of the pre-tokens of its lower-cased form.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        (self.mark,) = self.tok.encode(SEPARATOR, add_special_tokens=False).ids
        # the first KNOWN words with their ids: most words of a shard were in one before
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each word)."""
        get = self.known.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        ids, sizes = self._new_ids([words[i] for i in new.tolist()])
        at[new] = len(self.sizes) + np.arange(len(new))
        flat, size = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
        start = np.cumsum(size) - size
        out = ragged(flat, start[at], size[at]), size[at]
        if room := min(len(new), KNOWN - len(self.known)):
            self.known.update((words[i], len(self.sizes) + k) for k, i in enumerate(new[:room].tolist()))
            self.flat, self.sizes = np.concatenate([self.flat, ids[: int(sizes[:room].sum())]]), np.concatenate([self.sizes, sizes[:room]])
        return out

    def _new_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 20_000):
            some = words[k : k + 20_000]
            text = f" {SEPARATOR} ".join([*some, ""])
            ids = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(some) == text.count(SEPARATOR):
                parts.append(ids[ids != self.mark])
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:
                each = [x.ids for x in self.tok.encode_batch(some, add_special_tokens=False)]
                parts.append(np.array([i for x in each for i in x], np.uint32))
                sizes.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(parts), np.concatenate(sizes)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same, for distinct words."""
        plain = pc.match_substring_regex(words, PLAIN)
        simple, rest = words.filter(plain), words.filter(pc.invert(plain))
        lists = pc.split_pattern(pc.utf8_rtrim(pc.replace_substring_regex(pc.utf8_lower(simple), f"({PIECE})", r"\1 "), " "), " ")
        coded = lists.flatten().dictionary_encode()
        ids, sizes = self._ids(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy()
        flat, ends = ragged(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]), np.concatenate([[0], np.cumsum(sizes[at])])
        bounds = lists.offsets.to_numpy()[: len(lists) + 1]
        rest_flat, rest_sizes = self._ids(rest.to_pylist())
        order = np.empty(len(words), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        order[mask], order[~mask] = np.arange(len(simple)), len(simple) + np.arange(len(rest))
        size = np.concatenate([np.diff(ends[bounds - bounds[0]]) if len(lists) else np.zeros(0, np.int64), rest_sizes])
        start = np.cumsum(size) - size
        both = np.concatenate([flat, rest_flat])
        return ragged(both, start[order], size[order]), size[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; number of ids of each). A null text has none."""
        texts = texts.fill_null("")
        for c in "\n\t\r":
            texts = pc.replace_substring(texts, c, " ")
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        flat, size = self._words(coded.dictionary)
        at = coded.indices.to_numpy()
        ids = ragged(flat.astype(np.uint16) if not len(flat) or flat.max() < 65536 else flat, (np.cumsum(size) - size)[at], size[at])
        before = np.concatenate([[0], np.cumsum(size[at])])
        rows = words.offsets.to_numpy()[: len(words) + 1]
        return ids, np.diff(before[rows - rows[0]]) if len(words) else np.zeros(0, np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=8)
def combinations(window: int, step: int) -> np.ndarray:
    """Columns of the least squares: how often each length bucket occurs in a filled window.

    Bucket b (from 1) holds lengths up to b * step. A combination of up to three
    buckets is kept if it fits and no further bucket-wide piece would.
    """
    n = window // step
    found = []
    for a in range(n, 0, -1):
        if a == n:
            found.append((a,))
        for b in range(min(a, n - a), 0, -1):
            if a + b == n:
                found.append((a, b))
            c = n - a - b
            if 1 <= c <= b:
                found.append((a, b, c))
    out = np.zeros((n, len(found)))
    for k, combo in enumerate(found):
        for b in combo:
            out[b - 1, k] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 200) -> np.ndarray:
    """argmin |a x - b| over x >= 0 by active sets (Lawson and Hanson, 1974)."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    gram, right = a.T @ a, a.T @ b
    for _ in range(rounds):
        gain = right - gram @ x
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(gram[np.ix_(at, at)], right[at], rcond=None)[0]
            if s.min() > 1e-12:
                x[:] = 0
                x[at] = s
                break
            low = s <= 1e-12
            ratio = x[at][low] / np.maximum(x[at][low] - s[low], 1e-300)
            x[at] += ratio.min() * (s - x[at])
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                return x
    return x


def plan(lengths: np.ndarray, window: int = WINDOW, step: int = STEP) -> np.ndarray:
    """Pieces that pack documents of these lengths without padding.

    Returns rows (document, start, length, sequence, offset): every id is in one
    piece, every sequence is full or has a power of two of ids, and offsets in
    a sequence have no gaps.
    """
    lengths = np.asarray(lengths, np.int64)
    whole, rest = lengths // window, lengths % window
    doc = np.repeat(np.arange(len(lengths)), whole)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    done = [np.stack([doc, k * window, np.full(len(doc), window), np.arange(len(doc)), np.zeros(len(doc), np.int64)], 1)]
    bins = _combined(rest, window, step)
    used = np.zeros(len(lengths), bool)
    for members in bins:
        used[members] = True
    left = np.flatnonzero(~used & (rest > 0))
    left = left[np.argsort(rest[left], kind="stable")]
    bins, left = _best_fit(bins, list(map(int, left)), rest, window)
    room = np.array([window - int(rest[m].sum()) for m in bins], np.int64)
    filler = list(left)
    while bins and room.sum() > rest[filler].sum():  # nothing is left to close these gaps with
        filler += bins.pop()
        room = room[:-1]
    filler = np.array(filler, np.int64)
    over = int(rest[filler].sum() - room.sum())
    tail = [window] * (over // window) + [1 << b for b in range(window.bit_length() - 1, -1, -1) if over % window >> b & 1]
    capacity = np.concatenate([room, np.array(tail, np.int64)])
    base = len(doc)
    members = np.array([m for x in bins for m in x], np.int64)
    sizes = np.array([len(x) for x in bins], np.int64)
    sequence = np.repeat(np.arange(len(bins)), sizes)
    ends = np.cumsum(rest[members])
    begin = np.concatenate([[0], ends])[np.cumsum(sizes) - sizes] if len(bins) else np.zeros(0, np.int64)
    offset = ends - rest[members] - np.repeat(begin, sizes)
    done.append(np.stack([members, lengths[members] - rest[members], rest[members], base + sequence, offset], 1))
    # the filler is one stream, cut where a document or a gap ends
    doc_end, gap_end = np.cumsum(rest[filler]), np.cumsum(capacity)
    cut = np.union1d(doc_end, gap_end)
    cut = cut[cut > 0]
    low = np.concatenate([[0], cut[:-1]]).astype(np.int64)
    if len(cut):
        d, g = np.searchsorted(doc_end, low, "right"), np.searchsorted(gap_end, low, "right")
        owner = filler[d]
        start = low - (doc_end[d] - rest[owner]) + lengths[owner] - rest[owner]
        inside = low - (gap_end[g] - capacity[g])
        already = np.where(g < len(bins), window - capacity[g], 0)
        done.append(np.stack([owner, start, cut - low, base + g, already + inside], 1))
    out = np.concatenate(done).astype(np.int64)
    _, out[:, 3] = np.unique(out[:, 3], return_inverse=True)
    return out


def _combined(rest: np.ndarray, window: int, step: int) -> list[list[int]]:
    """Documents grouped by the rounded least-squares counts."""
    n = window // step
    bucket = (rest + step - 1) // step
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=n + 1)[: n + 1]
    queue = np.cumsum(counts) - counts
    columns = combinations(window, step)
    times = np.floor(nnls(columns, counts[1:].astype(float)) + 1e-9).astype(int)
    stop = queue + counts
    bins: list[list[int]] = []
    for k in np.flatnonzero(times):
        need = columns[:, k].astype(int)
        of = np.flatnonzero(need) + 1
        t = min([int(times[k]), *((stop[of] - queue[of]) // need[of - 1])])
        if t <= 0:
            continue
        take = []
        for b in of:
            m = int(need[b - 1])
            take.append(order[queue[b] : queue[b] + m * t].reshape(t, m))
            queue[b] += m * t
        bins += np.concatenate(take, 1).tolist()
    return bins


def _best_fit(bins: list[list[int]], left: list[int], rest: np.ndarray, window: int) -> tuple[list[list[int]], list[int]]:
    """Greedy best fit of the documents that are left (ascending) into old gaps, then new windows."""
    size = [int(rest[i]) for i in left]

    def fill(members: list[int], room: int) -> None:
        while size and (at := bisect.bisect_right(size, room) - 1) >= 0:
            room -= size.pop(at)
            members.append(left.pop(at))

    for members in bins:
        if not size:
            break
        room = window - int(rest[members].sum())
        if room >= size[0]:
            fill(members, room)
    while sum(size) >= window:
        first = left.pop()
        new, room = [first], window - size.pop()
        fill(new, room)
        bins.append(new)
    return bins, left


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack every document of docs into sequences of at most `window` ids.

    One row per piece: the id column, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, the piece's ids.

    A null or empty text is the end id alone; a null id stays null; repeated
    rows are documents of their own; other columns are ignored; an empty table
    gives no rows. A text of any length is packed whole.
    """
    spark: SparkSession = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {PIECES}" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer_path), 0
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            name, texts = table.column(0).combine_chunks(), table.column(1).combine_chunks().cast(pa.large_string())
            del table
            ids, n = enc.encode(texts)
            del texts
            give_back()
            ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
            first = np.cumsum(n) - n
            pieces = plan(n, window)
            # 2**19 partitions of 2**24 shards of 2**20 sequences
            base = (part << 44) + (shard << 20)
            if shard >> 24 or part >> 19 or len(pieces) and pieces[:, 3].max() >> 20:
                raise OverflowError("more shards, partitions or sequences than sequence ids can tell apart")
            shard += 1
            for k in range(0, len(pieces), 20_000):
                d, start, length, sequence, offset = pieces[k : k + 20_000].T
                a = first[d] + start
                crc = np.fromiter((zlib.crc32(ids[x : x + m].astype("<u4")) for x, m in zip(a.tolist(), length.tolist(), strict=True)), np.int64, len(a))
                cols = [name.take(pa.array(d)), *map(pa.array, (start, length, crc, n[d], base + sequence, offset))]
                if with_ids:
                    offs = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(ragged(ids, a, length).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids])

        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(x.nbytes for x in held) >= SHARD_BYTES:
                yield from flush()
        yield from flush()

    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)
