"""Shared pieces of the training-data operators: scratch tables, packed shuffles, byte-level tokens and hashes.

Several operators move millions of small facts (anchors, shingles, postings). They ship them as *packed rows*: a map
task turns a batch into a few binary blobs of numpy columns, one for each bucket of a hash, and Spark shuffles those
rows by bucket. A reducer streams bucket by bucket, so its memory follows the bucket, not the partition.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import struct
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
#: ASCII white space that separates words: blank and \t \n \v \f \r.
SEPARATORS = b" \t\n\x0b\x0c\r"
_SEP = np.zeros(256, bool)
_SEP[list(SEPARATORS)] = True
#: Rows of one Arrow batch are worked on in runs of about so many bytes of text.
RUN_BYTES = 1 << 19


_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that spark.checkpoint.dir names; it goes when the driver's Python ends. Where the
    setting is unset a local master gets a temporary folder, and any other an error: executors don't see the driver's disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@atexit.register
def _clear() -> None:
    jvm = SparkContext._jvm
    for path in _made if jvm else ():
        with contextlib.suppress(Exception):  # the JVM or the folder may be gone
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)


def column(df: DataFrame, name: str) -> F.Column:
    """A column by its whole name, whatever signs that has."""
    return df["`" + name.replace("`", "``") + "`"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: the lineage ends there, losing executors costs nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def has(df: DataFrame, *names: str) -> DataFrame:
    """The columns that an operator works on, and nothing else: extra columns can't clash with its own."""
    return df.select(*[df[n] for n in names])


# --- hashes ---------------------------------------------------------------------------------------------------------


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3 (public domain), on a copy."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


BASE = U64(0x9E3779B97F4A7C15)
_INV = U64(pow(int(BASE), -1, 1 << 64))
T1 = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
T2 = mix(T1 ^ U64(0xA0761D6478BD642F))
_POW: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i, modulo 2**64, for i < n at least."""
    if len(_POW[0]) < n:
        n = max(n, 2 * RUN_BYTES)
        for i, b in enumerate((BASE, _INV)):
            x = np.full(n, b, U64)
            x[0] = 1
            _POW[i] = np.multiply.accumulate(x)
    return _POW[0], _POW[1]


def prefix(sym: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; see span_hash()."""
    out = np.zeros(len(sym) + 1, U64)
    np.cumsum(sym * powers(len(sym) + 1)[0][: len(sym)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the symbols start..end, wherever they stand."""
    return mix((pre[end] - pre[start]) * powers(len(pre))[1][start])


def grams(h1: np.ndarray, k: int) -> np.ndarray:
    """The polynomial hash of every k consecutive symbols, by doubling."""
    parts, level, size, done = None, h1, 1, 0
    n = len(h1) - k + 1
    while size <= k:
        if k & size:
            piece = level[done : done + n]
            parts = piece.copy() if parts is None else parts * U64(pow(int(BASE), size, 1 << 64)) + piece
            done += size
        if size * 2 <= k:
            level = level[:-size] * U64(pow(int(BASE), size, 1 << 64)) + level[size:]
        size *= 2
    return parts


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    size = 1
    n = len(v) - w + 1
    while size * 2 <= w:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:n], v[w - size : w - size + n])


# --- texts ----------------------------------------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one run of UTF-8 bytes, and where each begins and the last ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_runs(off: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `most` bytes together; a longer text is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the number of the first word of each text."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    ink = ~_SEP[data]
    before = np.zeros(n, bool)
    before[1:] = ink[:-1]
    before[off[off < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = ink[1:]
    after[off[off > 0] - 1] = False
    start = np.flatnonzero(ink & ~before)
    return start, np.flatnonzero(ink & ~after) + 1, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = T1) -> np.ndarray:
    return span_hash(prefix(table[data]), start, end)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] of them, then those of start[1], and so on."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    return np.arange(total, dtype=np.int64) + np.repeat(start - first, count)


# --- packed rows ----------------------------------------------------------------------------------------------------

_C = zstandard.ZstdCompressor(level=1, write_content_size=True)
_D = zstandard.ZstdDecompressor()


def pack(small: list[np.ndarray], raw: list[np.ndarray] = ()) -> bytes:
    """Columns as one binary: `small` ones compressed, `raw` ones (hashes) as they are."""
    body = _C.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in small))
    head = [struct.pack("<HHI", len(small), len(raw), len(body))]
    head += [struct.pack("<2sI", a.dtype.str[1:].encode(), len(a)) for a in (*small, *raw)]
    return b"".join([*head, body, *(np.ascontiguousarray(a).tobytes() for a in raw)])


def unpack(blob: bytes) -> list[np.ndarray]:
    n, m, size = struct.unpack_from("<HHI", blob, 0)
    heads = [struct.unpack_from("<2sI", blob, 8 + 6 * i) for i in range(n + m)]
    at = 8 + 6 * (n + m)
    body = _D.decompress(blob[at : at + size])
    out, place = [], 0
    for i, (kind, count) in enumerate(heads):
        if i == n:
            body, place = blob, at + size
        out.append(np.frombuffer(body, "<" + kind.decode(), count, place))
        place += out[-1].nbytes
    return out


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


def split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The row numbers of each bucket, in their order."""
    if len(bucket):
        order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 65536 else bucket, kind="stable")
        b = bucket[order]
        cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        for i, j in zip(cut, np.r_[cut[1:], len(b)]):
            yield int(b[i]), order[i:j]


PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
PACKED_SQL = "bucket int, kind int, blob binary"


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packed_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, x = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(x, pa.binary())], schema=PACKED)


def packed_batches(rows: Iterator[tuple[int, int, bytes]], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= most:
            yield packed_batch(held)
            held, size = [], 0
    if held:
        yield packed_batch(held)


def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another system: its allocator decides
        return None


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks, beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    if (libc := _libc()) is not None:
        libc.malloc_trim(0)


#: Bytes of an Arrow batch, beside which an executor must hold the JVM's copy and a task's own arrays.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Batches of long texts get as small as BATCH_BYTES, unless the session already asks for smaller ones."""
    size = re.fullmatch(r"(-?\d+)([kmg]?)b?", str(spark.conf.get(_BATCH_SETTING)).lower())
    if size is None or not 0 < int(size[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[size[2]] <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(fn, schema); a task's memory goes back when it ends. Where schema is df's own, columns whose names
    Spark would read as paths get others on the way."""
    names = df.columns
    if any(set(c) & set(".`") for c in names):
        safe = [f"column {i} of {len(names)}" if set(c) & set(".`") else c for i, c in enumerate(names)]
        kinds = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(safe, schema.fields)])
        return map_batches(df.toDF(*safe), fn, kinds).toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def by_bucket(df: DataFrame, fn: Callable[[int, Iterator[tuple[int, bytes]]], Iterator], schema: str) -> DataFrame:
    """fn(bucket, (kind, blob)s in the order of kind) over packed rows; it yields Arrow batches. All rows of a bucket meet
    in one task, which streams its buckets one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, k, x) for batch in batches for b, k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)))
        held = next(rows, None)

        def one(bucket: int) -> Iterator[tuple[int, bytes]]:
            nonlocal held
            while held is not None and held[0] == bucket:
                row, held = held, None
                yield row[1], row[2].as_py()
                held = next(rows, None)

        while held is not None:
            bucket = held[0]
            part = one(bucket)
            yield from fn(bucket, part)
            for _ in part:
                pass
            release()

    n = partitions(df.sparkSession)
    small_batches(df.sparkSession)
    return df.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket", "kind").mapInArrow(run, schema)


def row_id(*cols: str) -> F.Column:
    """Identifies a row by its values: equal rows are one, rows that share only their id are not."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
