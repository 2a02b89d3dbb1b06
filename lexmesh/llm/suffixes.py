"""Suffix-array dedup: bytes under strings of `width` bytes that start more than once.

The order of all suffixes through `width` bytes is found by radix passes from
the most significant digit on, where only suffixes that still share a bucket go
on to the next pass; buckets of the last pass are exactly the repeated strings.
Three things keep the passes far below the size of the text:

* First digit: in every window of `width` bytes the leftmost k-byte string with
  the smallest hash is its anchor. Equal windows have equal anchors at equal
  places, so only anchors (about two per width - k bytes) are bucketed, and a
  window whose anchor is alone in its bucket is alone too.
* Second digit: all windows in a row with the same anchor occurrence form a
  segment. Its whole content is one digit: a bucket of two equal segments
  settles all their windows at once.
* Last digit: only windows of segments whose anchor repeats but whose content
  doesn't (at the edges of repeated passages) are bucketed one by one. Such
  segments are sent as they are, to the task that has their anchor's bucket; if
  a bucket holds more than HOT contents, its windows are sent one by one, by
  their own hashes, so that no bucket of any size meets in one task.

The passes send packed records by hash, and each task first merges equal ones
that it holds, so a string in a third of all documents comes once from each task.
There is one part for so many bytes of input, and a task takes its parts one by one.

Windows are equal if two independent 64-bit hashes are; segments are if the hashes
of their anchor and of their content are. At n strings that share an anchor, about
n*n/2^65 false pairs of segments are expected, and n*n/2^129 of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, by_part, column_bytes, dealt, lean, materialize, mix64, parts_for, prefix_hash, ragged, slices, span_hash, spread, tune

WIDTH = 200
ANCHOR = 64
#: Packed records per message: keeps rows small for Spark.
MESSAGE = 1 << 18

SEGMENT = np.dtype([("h", "<u8"), ("sig", "<u8"), ("did", "<i8"), ("th", "<i4"), ("start", "<u4"), ("n", "<u2"), ("state", "u1")])
PLACE = np.dtype([("h", "<u8"), ("start", "<u4"), ("n", "<u2"), ("state", "u1")])
CONTENT = np.dtype([("h", "<u8"), ("did", "<i8"), ("th", "<i4"), ("start", "<u4"), ("n", "<u2"), ("state", "u1")])
WINDOW = np.dtype([("w", "<u8"), ("v", "<u8"), ("did", "<i8"), ("th", "<i4"), ("start", "<u4"), ("n", "<u2"), ("state", "u1")])
RUN = np.dtype([("start", "<u4"), ("n", "<u2")])
OF_DOCUMENT = [("did", "<i8"), ("th", "<i4"), ("state", "u1")]
ONE, SETTLED, MANY = 0, 1, 2  # states sent: one occurrence; nothing to ask; occurs again in the sending task
# states of places: repeated; to be settled by window; repeated, and gives its windows to others; the last two in a hot bucket
DONE, OPEN, GIVES, HOT_OPEN, HOT_GIVES = 0, 1, 2, 3, 4
HOT = 4096


def anchors(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, k: int = ANCHOR) -> np.ndarray:
    """Segments (h, sig, row, start in its row, n windows) of the rows of a slice, as a record array."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, SEGMENT)
    pre, down = prefix_hash(data, 0)
    at = np.arange(len(data) - k + 1)
    h = span_hash(pre, down, at, at + k)
    low = (h & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)  # leftmost among equals
    span, have = width - k + 1, 1
    while have * 2 <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    spot = (low[:n] & np.uint64(0xFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    inside = np.zeros(n + 1, np.int8)
    ok = sizes >= width
    np.add.at(inside, offsets[:-1][ok], 1)
    ends = offsets[1:][ok] - width + 1
    np.add.at(inside, ends, -1)
    valid = np.cumsum(inside[:n]) > 0
    starts_of_rows = np.zeros(n, bool)
    starts_of_rows[offsets[:-1][ok]] = True
    begins = valid & (starts_of_rows | np.concatenate([[True], (spot[1:] != spot[:-1]) | ~valid[:-1]]))
    first = np.flatnonzero(begins)
    stop = valid & np.concatenate([begins[1:] | ~valid[1:], [True]])
    last = np.flatnonzero(stop)
    out = np.zeros(len(first), SEGMENT)
    row = np.searchsorted(offsets, first, "right") - 1
    out["h"], out["did"], out["start"], out["n"] = h[spot[first]], row, first - offsets[row], last - first + 1
    pre2, down2 = prefix_hash(data, 1)
    out["sig"] = mix64(span_hash(pre2, down2, first, last + width) + (last - first).astype(np.uint64))
    return out


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts by the keys, number of the group of each row in that order)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        s = key[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def _combine(records: np.ndarray, keys: tuple[str, ...]) -> np.ndarray:
    """One record per key goes out as MANY if there are more; the others are SETTLED."""
    order, group = _groups(*(records[k] for k in keys))
    if not len(order):
        return records
    records = records[order]
    many = np.bincount(group) > 1
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    multiple = many[group]
    records["state"] = np.where(multiple & first, MANY, np.where(multiple, SETTLED, records["state"]))
    return records


def _messages(records: np.ndarray, key: str, parts: int) -> Iterator[pa.RecordBatch]:
    """(pid, blob) rows; settled records go by document, so that they don't meet at their key."""
    by = np.where(records["state"] == SETTLED, records["did"].astype(np.uint64), records[key].astype(np.uint64))
    pid = (mix64(by) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(pid, kind="stable")
    records, pid = records[order], pid[order]
    cuts = np.flatnonzero(np.diff(pid)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pid)]]), strict=True):
        for i in range(int(a), int(b), MESSAGE):
            j = min(i + MESSAGE, int(b))
            yield pa.RecordBatch.from_arrays([pa.array([pid[i]], pa.int32()), pa.array([records[i:j].tobytes()], pa.binary())], ["pid", "blob"])


def _received(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The records of each part."""
    for _, rows in by_part(batches):
        yield np.concatenate([np.frombuffer(x, kind) for batch in rows for x in batch.column(1).to_pylist()])


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), RUN)
    out["start"], out["n"] = start, n
    return out


def _contents(heads: np.ndarray, body: np.ndarray, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """(pid, blob, text) rows: segments with their bytes, to the task of their anchor."""
    size = heads["n"].astype(np.int64) + width - 1
    start = np.cumsum(size) - size
    pid = (mix64(heads["h"]) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(pid, kind="stable")
    cuts = np.flatnonzero(np.diff(pid[order])) + 1
    for some in np.split(order, cuts):
        for i in range(0, len(some), 8192):
            x = some[i : i + 8192]
            yield pa.RecordBatch.from_arrays([pa.array([pid[x[0]]], pa.int32()), pa.array([heads[x].tobytes()], pa.binary()), pa.array([ragged(body, start[x], size[x]).tobytes()], pa.binary())], ["pid", "blob", "text"])


def _same_windows(heads: np.ndarray, body: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(did, th, runs) of the windows of open segments that another segment of their anchor has as well."""
    size = heads["n"].astype(np.int64) + width - 1
    first = np.cumsum(size) - size
    n = heads["n"].astype(np.int64)
    order = np.argsort(heads["h"], kind="stable")
    did, th, runs = [], [], []
    cuts = np.flatnonzero(np.diff(heads["h"][order])) + 1
    held: list[np.ndarray] = []
    weight = 0
    groups = np.split(order, cuts)
    for k, some in enumerate(groups):  # whole buckets, a megabyte at a time
        held.append(some)
        weight += int(size[some].sum())
        if weight > 1 << 20 or k == len(groups) - 1:
            x = np.concatenate(held)
            held, weight = [], 0
            text = ragged(body, first[x], size[x])
            at = np.repeat(np.cumsum(size[x]) - size[x], n[x]) + spread(n[x])
            pre, down = prefix_hash(text)
            w = span_hash(pre, down, at, at + width)
            pre, down = prefix_hash(text, 1)
            owner = np.repeat(x, n[x])
            place = heads["start"][owner] + spread(n[x]).astype(np.uint32)
            o, g = _groups(w, span_hash(pre, down, at, at + width))
            hit = np.zeros(len(w), bool)
            hit[o] = (np.bincount(g) > 1)[g]
            hit &= heads["state"][owner] == OPEN
            new = np.ones(len(w), bool)
            new[1:] = (owner[1:] != owner[:-1]) | ~hit[:-1]
            begin = np.flatnonzero(hit & new)
            end = np.flatnonzero(hit & np.concatenate([(owner[1:] != owner[:-1]) | ~hit[1:], [True]]))
            did.append(heads["did"][owner[begin]])
            th.append(heads["th"][owner[begin]])
            runs.append(_runs(place[begin], end - begin + 1))
    return np.concatenate(did), np.concatenate(th), np.concatenate(runs)


def _windows(r: np.ndarray) -> np.ndarray:
    """Windows of hot buckets: one of each hash asks for all that a task holds; the rest is settled, in runs."""
    gives = r["state"] >= 8
    order = np.lexsort((gives, r["v"], r["w"]))  # those that need an answer first
    r, gives = r[order], gives[order]
    new = np.concatenate([[True], (r["w"][1:] != r["w"][:-1]) | (r["v"][1:] != r["v"][:-1])])
    several = (np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]
    r["state"] = np.where(several & new, np.where(gives, MANY + 8, MANY), np.where(several, SETTLED, np.where(gives, ONE + 8, ONE)))
    r = r[~(several & ~new & gives)]
    done = np.sort(r[r["state"] == SETTLED], order=["did", "th", "start"])
    if len(done):
        first = np.flatnonzero(np.concatenate([[True], (done["did"][1:] != done["did"][:-1]) | (done["th"][1:] != done["th"][:-1]) | (done["start"][1:] != done["start"][:-1] + 1)]))
        count = np.diff(np.concatenate([first, [len(done)]]))
        done = done[first]
        done["n"] = count
    return np.concatenate([r[r["state"] != SETTLED], done])


def _to_document(did: np.ndarray, th: np.ndarray, places: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """(pid, blob) rows that take places to the task of their document."""
    out = np.zeros(len(did), OF_DOCUMENT + [("place", places.dtype)])
    out["did"], out["th"], out["place"] = did, th, places
    if len(out):
        yield from _messages(out, "did", parts)


def _by_document(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """One row (did, th, places) per document from such messages."""
    for r in _received(batches, np.dtype(OF_DOCUMENT + [("place", kind)])):
        did, th, places = (np.ascontiguousarray(r[k]) for k in ("did", "th", "place"))
        order, group = _groups(did, th)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rows = np.concatenate([first, [len(order)]])
        for i in range(0, len(first), 20_000):
            a, b = rows[i], rows[min(i + 20_000, len(first))]
            offs = rows[i : min(i + 20_000, len(first)) + 1] - a
            f = order[first[i : i + 20_000]]
            yield pa.RecordBatch.from_arrays([pa.array(did[f]), pa.array(th[f]), binary_array(offs, places[order[a:b]])], ["_did", "_th", "_places"])


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [a, b) that the spans cover; starts ascending."""
    if not len(starts):
        return starts, starts
    ends = np.maximum.accumulate(starts + lengths)
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    a = starts[new]
    b = ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])]
    return a, np.minimum(b, n)


def _result(raw: bytes, starts: np.ndarray, counts: np.ndarray, width: int, with_spans: bool) -> tuple:
    order = np.argsort(starts, kind="stable")
    a, b = _covered(len(raw), starts[order].astype(np.int64), counts[order].astype(np.int64) + width - 1)
    keep = hashlib.sha256()
    at = 0
    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        keep.update(raw[at:x])
        if with_spans:
            kept.append(raw[at:x])
        at = y
    keep.update(raw[at:])
    if with_spans:
        kept.append(raw[at:])
    return len(raw), int((b - a).sum()), len(a), keep.hexdigest(), b"".join(kept).decode("utf-8", "replace") if with_spans else None


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, keep_cols: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """(id, keep_cols, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]) for each row of docs.

    A byte is removed if a string of `width` bytes that covers it starts anywhere
    else, in the same document or another; strings never cross documents. kept_text
    is what remains, read as UTF-8 (a cut character becomes U+FFFD). A column of
    keep_cols that has the name of the id or of a result column is left out.

    A null text is empty, and texts shorter than `width` lose nothing; a null id
    is an id like any other; rows that repeat are documents of their own, so
    their texts of `width` bytes or more are removed whole; an empty table
    gives no rows; other columns are ignored. A document's text must be under 4 GB.
    """
    tune(docs.sparkSession)
    parts = parts_for(docs)
    k = min(ANCHOR, max(1, width // 2))
    kept = [c for c in keep_cols if c not in (id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")]
    base = docs.select(F.col(id_col).alias("_id"), *[F.struct(*kept).alias("_keep")] * bool(kept), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    base = base.withColumn("_did", F.xxhash64("_id")).withColumn("_th", F.hash("_text"))
    cols = ["_id", *["_keep"] * bool(kept)]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            offsets, data = column_bytes(batch.column(2))
            did, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in slices(offsets, MOST):
                for i, j in _chunks(int(offsets[a]), int(offsets[b]), width):
                    got = anchors(data[i:j], np.clip(offsets[a : b + 1], i, j) - i, width, k)
                    row = got["did"] + a
                    if i > offsets[a]:
                        got["start"] += np.uint32(i - offsets[a])
                    got["did"], got["th"] = did[row], th[row]
                    held.append(got)
            if sum(map(len, held)) > 500_000:
                yield from _messages(_combine(np.concatenate(held), ("h", "sig")), "h", parts)
                held = []
        if held:
            yield from _messages(_combine(np.concatenate(held), ("h", "sig")), "h", parts)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _received(batches, SEGMENT):
            place = np.zeros(len(r), PLACE)
            place["h"], place["start"], place["n"] = r["h"], r["start"], r["n"]
            ask = np.flatnonzero(r["state"] != SETTLED)
            use = r["state"] == SETTLED
            if len(ask):
                s = r[ask]
                order, group = _groups(s["h"], s["sig"])
                s, ask = s[order], ask[order]
                repeated = (np.bincount(group) > 1) | (np.bincount(group, s["state"] == MANY) > 0)
                first = np.concatenate([[True], group[1:] != group[:-1]])
                heads = np.flatnonzero(first)
                anchor = np.concatenate([[0], np.cumsum(s["h"][heads][1:] != s["h"][heads][:-1])])
                kinds = np.bincount(anchor)[anchor]
                shared = kinds > 1  # the anchor has other contents as well
                state = np.where(repeated[group], np.where(shared[group] & first, GIVES, DONE), OPEN)
                state = np.where((kinds > HOT)[group] & (state != DONE), state + (HOT_OPEN - OPEN), state)
                use[ask] = repeated[group] | shared[group]
                place["state"][ask] = state
            yield from _to_document(r["did"][use], r["th"][use], place[use], parts)

    sent = base.select("_did", "_th", "_text").mapInArrow(lean(first_pass), "pid int, blob binary")
    settled = dealt(sent, parts).mapInArrow(lean(settle), "pid int, blob binary")
    lists = dealt(settled, parts).mapInArrow(lean(lambda batches: _by_document(batches, PLACE)), "_did long, _th int, _places binary")
    joined = base.join(lists, ["_did", "_th"], "left")
    kinds = ", ".join(f"{c} {base.schema[c].dataType.simpleString()}" for c in cols)
    done_kind = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    where = len(cols)

    def places_of(column: pa.Array, i: int, kind: np.dtype) -> np.ndarray:
        x = column[i].as_py()
        return np.frombuffer(x, kind) if x else np.zeros(0, kind)

    def finished(rows: list[tuple]) -> list[pa.Array]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return [pa.array([x[i] if x else None for x in rows], t) for i, t in enumerate(kinds)]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = column_bytes(batch.column(where))
            rows, left = [], []
            for i in range(len(batch)):
                p = places_of(batch.column(where + 3), i, PLACE)
                if (p["state"] != DONE).any():
                    rows.append(None)
                    left.append(p.tobytes())
                else:
                    rows.append(_result(data[offsets[i] : offsets[i + 1]].tobytes(), p["start"], p["n"], width, with_text))
                    left.append(None)
            open_ = pa.array([x is not None for x in left])
            text = pc.if_else(open_, batch.column(where), pa.scalar(None, batch.column(where).type))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(where)), *finished(rows), batch.column(where + 1), batch.column(where + 2), text, pa.array(left, pa.binary())], [*cols, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "_did", "_th", "_text", "_places"])

    ready = joined.select(*cols, "_text", "_did", "_th", "_places").mapInArrow(lean(finish), f"{kinds}, {done_kind}, _did long, _th int, _text string, _places binary")
    state = materialize(ready, "suffixes")
    open_docs = state.where("_places is not null")

    def window_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, bodies, windows = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if heads:
                yield from _contents(np.concatenate(heads), np.concatenate(bodies), width, parts)
            if windows:
                for m in _messages(_windows(np.concatenate(windows)), "w", parts):
                    yield pa.RecordBatch.from_arrays([*m.columns, pa.array([None], pa.binary())], ["pid", "blob", "text"])
            heads.clear(), bodies.clear(), windows.clear()

        for batch in batches:
            offsets, data = column_bytes(batch.column(2))
            did, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(len(batch)):
                p = np.frombuffer(batch.column(3)[i].as_py(), PLACE)
                p = np.unique(p[p["state"] != DONE])
                text = data[offsets[i] : offsets[i + 1]]
                hot = p["state"] >= HOT_OPEN
                if not hot.all():
                    q = p[~hot]
                    head = np.zeros(len(q), CONTENT)
                    head["h"], head["did"], head["th"], head["start"], head["n"], head["state"] = q["h"], did[i], th[i], q["start"], q["n"], q["state"]
                    heads.append(head)
                    bodies.append(ragged(text, q["start"].astype(np.int64), q["n"].astype(np.int64) + width - 1))
                if hot.any():
                    q = p[hot]
                    at = np.repeat(q["start"].astype(np.int64), q["n"]) + spread(q["n"].astype(np.int64))
                    got = np.zeros(len(at), WINDOW)
                    for base, name in enumerate("wv"):
                        pre, down = prefix_hash(text, base)
                        got[name] = span_hash(pre, down, at, at + width)
                    got["did"], got["th"], got["start"], got["n"] = did[i], th[i], at, 1
                    got["state"] = np.repeat(np.where(q["state"] == HOT_GIVES, 8, 0), q["n"])  # a giver's windows need no answer
                    windows.append(got)
            if sum(map(len, bodies)) + sum(map(len, windows)) * 33 > 8 << 20:
                yield from flush()
        yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_part(batches):
            heads, bodies, windows = [], [], []
            for batch in rows:
                for blob, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if text is None:
                        windows.append(np.frombuffer(blob, WINDOW))
                    else:
                        heads.append(np.frombuffer(blob, CONTENT))
                        bodies.append(np.frombuffer(text, np.uint8))
            if heads:
                yield from _to_document(*_same_windows(np.concatenate(heads), np.concatenate(bodies), width), parts)
            if windows:
                r = np.concatenate(windows)
                use = r["state"] == SETTLED
                ask = np.flatnonzero(~use)
                if len(ask):
                    order, group = _groups(r["w"][ask], r["v"][ask])
                    ask = ask[order]
                    repeated = (np.bincount(group) > 1) | (np.bincount(group, (r["state"][ask] & 7) == MANY) > 0)
                    use[ask] = repeated[group] & (r["state"][ask] < 8)
                yield from _to_document(r["did"][use], r["th"][use], _runs(r["start"][use], r["n"][use]), parts)

    asked = open_docs.select("_did", "_th", "_text", "_places").mapInArrow(lean(window_pass), "pid int, blob binary, text binary")
    answers = dealt(asked, parts).mapInArrow(lean(answer), "pid int, blob binary")
    starts = dealt(answers, parts).mapInArrow(lean(lambda batches: _by_document(batches, RUN)), "_did long, _th int, _starts binary")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = column_bytes(batch.column(where))
            rows = []
            for i in range(len(batch)):
                p = np.frombuffer(batch.column(where + 1)[i].as_py(), PLACE)
                p = p[(p["state"] != OPEN) & (p["state"] != HOT_OPEN)]
                s = places_of(batch.column(where + 2), i, RUN)
                rows.append(_result(data[offsets[i] : offsets[i + 1]].tobytes(), np.concatenate([p["start"], s["start"]]), np.concatenate([p["n"], s["n"]]), width, with_text))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(where)), *finished(rows)], [*cols, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    last = open_docs.select(*cols, "_text", "_places", "_did", "_th").join(starts, ["_did", "_th"], "left").select(*cols, "_text", "_places", "_starts").mapInArrow(lean(close), f"{kinds}, {done_kind}")
    out = state.where("_places is null").select(*cols, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text").unionByName(last)
    return out.select(F.col("_id").alias(id_col), *(F.col("_keep")[c].alias(c) for c in kept), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text)


#: Bytes that the anchor kernel handles at once (its packed keys hold 24 bits of position).
MOST = 1 << 18


def _chunks(a: int, b: int, width: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most MOST bytes that overlap so that every window is in exactly one."""
    while True:
        j = min(a + MOST, b)
        yield a, j
        if j == b:
            return
        a = j - width + 1
