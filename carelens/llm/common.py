"""Shared helpers: text buffers, words, 64-bit segment hashes and the block table.

Texts are handled as one byte buffer plus row offsets (the Arrow layout), so numpy can work
on a whole run of rows at once. A null text is an empty text everywhere.

The *block table* holds runs of rows (about ``BLOCK_BYTES`` of text each) as one compressed
Arrow message per row, written once to the shared checkpoint folder. Jobs that must look up
facts about the content of a block and come back to it address the block by its id; a lost
executor re-reads the written table, so ids never change between jobs.
"""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.session import checkpoint_dir

def _give_back_memory() -> None:
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run):
    """A function for tasks that gives freed memory back to the system at its end: Python workers
    live on between tasks and stages, and would keep what the largest task took."""
    if inspect.isgeneratorfunction(run):

        def over_batches(batches):
            try:
                yield from run(batches)
            finally:
                _give_back_memory()

        return over_batches
    if len(inspect.signature(run).parameters) == 1:

        def over_group(group):
            try:
                return run(group)
            finally:
                _give_back_memory()

        return over_group

    def over_pair(first, second):
        try:
            return run(first, second)
        finally:
            _give_back_memory()

    return over_pair


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of the Arrow batches in which rows go to a Python worker. An executor holds a batch several
#: times (its vectors and the message, both of which grow by doubling), outside of its heap.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python workers in batches of ``BATCH_BYTES``, not of
    10,000 rows, which are some 20 MB of texts. A session that asks for less keeps its own setting.
    The setting stays: it is read when a query runs, which for a lazy result is after the call."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if not 0 < size(spark.conf.get(BATCH)) <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


#: Text bytes in one block of the block table (a longer document is a block of its own).
BLOCK_BYTES = 4 << 20
#: Text bytes that numpy works on at a time inside a task.
PIECE_BYTES = 2 << 20

#: The ASCII white space that ends a word: x20, x09-x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 5
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the row offsets (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def runs(offs: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes each, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(buf: np.ndarray, offs: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (``[^\\x20\\x09-\\x0D]+`` by default), and each row's first word."""
    solid = ~between[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        n = (n >> 18) + 1 << 18
        with np.errstate(over="ignore"):
            for name, x in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, x, np.uint64)
                steps[0] = 1
                _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["p"], _POWERS["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums (mod 2**64) that ``segment_hashes`` takes differences of."""
    p, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[buf] * p[: len(buf)], out=out[1:])
    return out


def segment_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of buf[start:end] for each pair, whatever the place in the buffer."""
    _, inverse = _powers(len(sums))
    with np.errstate(over="ignore"):
        h = (sums[ends] - sums[starts]) * inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two hashes."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0x9FB21C651E98DF25) + (b ^ (b >> np.uint64(29))))


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores until no column has it (in any case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/carelens-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again (lineage cut, lost tasks re-read)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def block_table(docs: DataFrame, columns: list[str], text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block long, n_bytes long, payload binary) of ``docs``, written once.

    Block ids are the partition and a running number; they are read from the written table
    ever after, so it does not matter whether a second scan would deal the rows alike.
    """
    at = columns.index(text)

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = 0, [], 0
        part = None

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            payload = pack(table.to_batches()[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                ["block", "n_bytes", "payload"],
            )

        for batch in batches:
            if part is None and batch.num_rows:
                part = batch.column(batch.num_columns - 1)[0].as_py()
            batch = batch.select(range(len(columns)))
            _, offs = text_buffer(batch.column(at))
            for i, j in runs(offs, block_bytes):
                held.append(batch.slice(i, j - i))
                size += int(offs[j] - offs[i])
                if size >= block_bytes // 2:
                    yield row()
                    number, held, size = number + 1, [], 0
        if held:
            yield row()

    rows = docs.select(*columns, F.spark_partition_id().alias("__part"))
    return written(rows.mapInArrow(build, "block long, n_bytes long, payload binary"), "blocks")


# Arrays between tasks: deltas and byte planes under zstd.


def squeeze(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as one compressed message."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], "<i8")
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(head.tobytes() + b"".join(planes), 3)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    shapes = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    at, out = 8 + 16 * n, []
    for size, length in shapes:
        planes = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{size}"))
        at += size * length
    return out


def deltas(x: np.ndarray) -> np.ndarray:
    """Of ascending unsigned numbers: the first, then the differences."""
    return np.diff(x, prepend=x.dtype.type(0)) if len(x) else x


def undelta(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(x, dtype=x.dtype)


def ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal parts of the 64-bit numbers begins in ascending keys, and the end."""
    edges = np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


# Exact equality of byte segments.

#: Beyond so many bytes a segment is handled on its own, not in a column of eight-byte digits.
LONG_SEGMENT = 256


def _digits(buf: np.ndarray) -> np.ndarray:
    """The eight bytes (little-endian, zeros past the end) from each byte on."""
    return np.ndarray((len(buf) + 1,), "<u8", buf.tobytes() + bytes(8), strides=(1,))


def _digit(digits: np.ndarray, starts: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next ``left`` bytes, eight at most, from each start."""
    x = digits[starts]
    short = left < 8
    x[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
    return x


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... (size of them) for each pair, in one array."""
    total = np.append(0, np.cumsum(sizes))
    return np.repeat(begins - total[:-1], sizes) + np.arange(total[-1])


def hash_segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each buf[start:end], digit by digit; memory goes with the segments, not with the buffer."""
    size = ends - starts
    digits = _digits(buf)
    h = mix(size.astype(np.uint64))
    live, at = np.flatnonzero(size > 0), 0
    with np.errstate(over="ignore"):
        while len(live) and at < LONG_SEGMENT:
            x = _digit(digits, starts[live] + at, size[live] - at)
            h[live] = mix((h[live] ^ mix(x + np.uint64(_BASE))) * np.uint64(0x9FB21C651E98DF25))
            at += 8
            live = live[size[live] > at]
        for i in live.tolist():
            rest = np.uint64(xxhash.xxh64_intdigest(buf[starts[i] + at : ends[i]], 7))
            h[i] = mix((h[i] ^ rest) * np.uint64(0x9FB21C651E98DF25))
    return h


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether buf[a:a+n] equals buf[b:b+n], for each triple."""
    same = np.ones(len(n), bool)
    digits = _digits(buf)
    live, at = np.flatnonzero((n > 0) & (a != b)), 0
    while len(live) and at < LONG_SEGMENT:
        left = n[live] - at
        equal = _digit(digits, a[live] + at, left) == _digit(digits, b[live] + at, left)
        same[live[~equal]] = False
        at += 8
        live = live[equal & (left > 8)]
    for i in live.tolist():
        same[i] = bool(np.array_equal(buf[a[i] + at : a[i] + n[i]], buf[b[i] + at : b[i] + n[i]]))
    return same


def distinct_segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): one representative of each distinct buf[start:end], and each one's number in it.

    Hashes group the segments, bytes decide: a segment that differs from its group's first one is
    told apart by its bytes, so two texts never count as one whatever their hashes."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, which = np.unique(hash_segments(buf, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    like = first[which]
    wrong = size != size[like]
    check = np.flatnonzero(~wrong)
    wrong[check] = ~same_bytes(buf, starts[check], starts[like[check]], size[check])
    seen: dict[bytes, int] = {}
    more = []
    for i in np.flatnonzero(wrong).tolist():
        data = buf[starts[i] : ends[i]].tobytes()
        if data not in seen:
            seen[data] = len(first) + len(more)
            more.append(i)
        which[i] = seen[data]
    return np.append(first, np.array(more, np.int64)), which
