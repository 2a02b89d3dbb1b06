"""What the operators of this subpackage share: scratch tables and byte-level helpers.

The numpy helpers work on the raw UTF-8 buffers of Arrow string arrays, so a
batch of texts is one byte array and no Python string is made per word.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: texts can be long, so batches hold few of them.
ARROW_ROWS = 1000
#: Bytes in an Arrow batch, in which one longer row still comes whole.
ARROW_BYTES = 8 << 20
#: Bytes of input for which one part of packed records is made.
PART_BYTES = 16 << 20
#: Bytes of text that the numpy kernels handle at once.
SLICE_BYTES = 1 << 20


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a Python worker, by rows and by bytes.

    The settings hold for the session from then on, as results are computed later;
    smaller settings of the caller stay.
    """
    for key, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        now = int(spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that df reads (sources that don't know their size count as empty)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def parts_for(df: DataFrame, each: int = PART_BYTES) -> int:
    """Parts in which packed records of df are dealt: they grow with the input, so that a part never does."""
    return max(shuffle_partitions(df.sparkSession), -(-input_bytes(df) // each))


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(part, its rows) of batches whose first column is ascending: one part is held at a time."""
    now, held = -1, []
    for batch in batches:
        pid = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(pid)) + 1).tolist(), len(pid)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and pid[a] != now:
                yield now, held
                held = []
            now = int(pid[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, held


def dealt(sent: DataFrame, parts: int, key: str = "pid") -> DataFrame:
    """sent by part, each part's rows together: what by_part reads."""
    return sent.repartition(parts, key).sortWithinPartitions(key)


_own_root: list[str] = []
#: Tables written by materialize, in order.
written: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors share.

    Only where the setting is absent and Spark runs in one JVM (as in tests) is a
    local folder made instead.
    """
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_root:
        _own_root.append(tempfile.mkdtemp(prefix="scratch-"))
    return _own_root[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tables/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at replicated files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete these tables, or all that operators have written; results that read them can't be read afterwards."""
    for place in [f"{shared_root(spark)}/tables"] if paths is None else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    written[:] = [] if paths is None else [x for x in written if x not in paths]


def give_back() -> None:
    """Free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving memory back to the system at its end: workers live on between tasks."""

    @wraps(run)
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return trimmed


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def labelled_sample(labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of at most `rows` labelled ids, chosen by a hash of the id; few enough to be broadcast.

    Ids and labels that are null are left out, and so are ids with both labels.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(F.min(F.col(label).cast("int")).alias(label), F.max(F.col(label).cast("int")).alias("_other"))
    known = known.where(F.col(label) == F.col("_other")).drop("_other")
    # the limit is met by the smallest hashes: the rows before it are cut to about twice as many by their share
    share = min(1.0, 2 * rows / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) <= int(share * (1 << 40)))
    return some.orderBy(F.xxhash64(id_col), id_col).limit(rows)


# ---------------------------------------------------------------- numpy on bytes


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (MurmurHash3's constants) on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


_BASES = (Powers(0x9E3779B97F4A7C15), Powers(0xD6E8FEB86659FD93))


def prefix_hash(data: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums with a leading 0, inverse powers) for span_hash."""
    up, down = _BASES[base].upto(len(data) + 1)
    pre = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=pre[1:])
    return pre, down


def span_hash(pre: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal spans have equal hashes."""
    return mix64((pre[end] - pre[start]) * down[start])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of n+1 int64, bytes) of a string or binary array; a null counts as empty."""
    large = pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.large_binary()
    column = column.fill_null("" if large == pa.large_string() else b"").cast(large)
    _, offs, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to `most` bytes, or one row if it is longer."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def table_of(pattern_bytes: Iterable[int]) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(pattern_bytes)] = True
    return t


#: Bytes of words: digits, ASCII letters and every byte of a non-ASCII character.
ALNUM = table_of([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Bytes between words of the plain kind: space, and tab to carriage return.
SOLID = ~table_of([0x20, *range(0x09, 0x0E)])
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row with a last n) of maximal runs of word bytes."""
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = word[data]
    inside[-1] = False
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begin = inside & ~before
    begin[cuts] = inside[cuts]
    end = ~inside & before
    end[cuts] = before[cuts]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def spread(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) - np.repeat(ends - lengths, lengths)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, piece: int = 1 << 19) -> np.ndarray:
    """The concatenation of flat[s : s + n] for each start s and length n."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, flat.dtype)
    for a in range(0, len(starts), piece):  # the index arrays are larger than the result
        s, n = starts[a : a + piece], lengths[a : a + piece]
        at = ends[a : a + piece]
        out[int(at[0] - n[0]) : int(at[-1])] = flat[np.repeat(s, n) + spread(n)]
    return out


def binary_array(rows: np.ndarray, flat: np.ndarray) -> pa.Array:
    """A binary array of len(rows)-1 values: flat's items between consecutive row offsets."""
    raw = np.ascontiguousarray(flat)
    offs = (np.asarray(rows, np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows) - 1, [None, pa.py_buffer(offs), pa.py_buffer(raw)])
