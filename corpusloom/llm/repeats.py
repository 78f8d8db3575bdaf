"""Passages of a fixed length that an earlier document holds too, found without shipping every position.

Shared by the suffix-array and the seed-and-extend deduplication. A *symbol* is a byte or a word.

1. Winnowing. Every window of `window` symbols has one anchor: the smallest of its k-grams by hash. Equal windows have
   equal anchors at equal places, so only anchors travel. Consecutive windows with one anchor form a *span*. A map task
   ships (anchor, span hash) and resolves what its own batch shows, so a hot passage costs one record per batch.
2. Spans that equal a span of a smaller document are covered whole. Spans that only share the anchor, and one side of
   it, with another span are asked for: their symbols are sent in a second exchange, where a method of the caller's
   finds the single windows that an earlier document has.
3. A last exchange brings documents and covered windows together.

Documents are compared by doc_id. A null doc_id counts as larger than all others. Equal doc_ids don't cover each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _common as C

U64 = np.uint64
NO_ID = np.iinfo(np.int64).max
#: Bytes of text whose anchors are combined before they are shipped.
COMBINE_BYTES = 6 << 20
COVERED, ASKED = 0, 1


@dataclass(frozen=True)
class Plan:
    """window: symbols of a passage. k: symbols of an anchor. by_word: symbols are words, else bytes."""

    window: int
    k: int
    by_word: bool

    @property
    def side(self) -> int:
        """A window holds so many symbols on one side of its anchor at least."""
        return max(1, (self.window - self.k + 1) // 2)


def symbols(plan: Plan, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each symbol, the symbols' offsets by document, and starts and ends of the symbols in the bytes."""
    if not plan.by_word:
        return C.T1[data], C.T2[data], off, off, off
    start, end, woff = C.words(data, off)
    h = C.word_hashes(data, start, end)
    return h, C.mix(h ^ U64(0x2545F4914F6CDD1D)), woff, start, end


def spans(plan: Plan, h1: np.ndarray, h2: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one anchor: document, first window in the document, number of windows, anchor's
    place in the span, hash of the anchor, hash of the span, and a byte for either side of the anchor (0: too short)."""
    n, w = len(h1), plan.window
    if n < w:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(U64), z.astype(U64), z.astype(np.uint8), z.astype(np.uint8)
    gram = C.mix(C.grams(h1, plan.k))
    bits = U64(max(1, n.bit_length()))
    low = C.sliding_min(((gram >> bits) << bits) | np.arange(len(gram), dtype=U64), w - plan.k + 1)
    low &= (U64(1) << bits) - U64(1)
    size = np.diff(off)
    long = size >= w
    edge = np.zeros(n + 1, np.int8)
    edge[off[:-1][long]] = 1
    edge[(off[1:] - w + 1)[long]] -= 1
    at = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8)[: n - w + 1])
    if not len(at):
        return spans(plan, h1[:0], h2[:0], off[:1])
    anchor = low[at]
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(at)])
    s, m = at[first], anchor[first].astype(np.int64)
    doc = np.searchsorted(off, s, "right") - 1
    begin, end = off[doc], off[doc + 1]
    pre = C.prefix(h2)
    whole = C.span_hash(pre, s, s + count - 1 + w)
    left, right = np.zeros(len(s), np.uint8), np.zeros(len(s), np.uint8)
    d = plan.side
    ok = m - d >= begin
    left[ok] = (C.span_hash(pre, m[ok] - d, m[ok]) % U64(255)).astype(np.uint8) + 1
    ok = m + plan.k + d <= end
    right[ok] = (C.span_hash(pre, m[ok] + plan.k, m[ok] + plan.k + d) % U64(255)).astype(np.uint8) + 1
    # anchors are small hashes by choice: they are hashed anew, or most would fall in the first bucket
    return doc, s - begin, count, m - s, C.mix(gram[m] ^ U64(0x94D049BB133111EB)), whole, left, right


# --- replies: which windows of a row are covered (COVERED) or asked for (ASKED) ---------------------------------------


def replies(rid: np.ndarray, pos: np.ndarray, count: np.ndarray, lead: np.ndarray, kind: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Packed rows for runs of windows; neighbouring covered runs become one."""
    if not len(rid):
        return
    order = np.lexsort((pos, rid))
    rid, pos, count, lead = rid[order], pos[order].astype(np.int64), count[order].astype(np.int64), lead[order]
    if kind == COVERED:
        joins = np.r_[False, (rid[1:] == rid[:-1]) & (pos[1:] <= (pos + count)[:-1])]
        if joins.any():  # ends may overlap: a run ends with the furthest end of its parts
            end = (pos + count)[:]
            first = np.flatnonzero(~joins)
            end = np.maximum.reduceat(end, first)
            rid, pos, lead = rid[first], pos[first], lead[first]
            count = end - pos
    for b, rows in C.split(C.bucket_of(rid, buckets)):
        r, p = rid[rows], pos[rows]
        head = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        step = np.diff(p, prepend=0).astype(np.int32)
        yield b, kind, C.pack([np.diff(np.r_[head, len(r)]).astype(np.int32), step, count[rows].astype(np.int32), lead[rows].astype(np.uint8)], [r[head]])


def read_replies(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """rid, pos, count, lead of all, ordered by rid."""
    parts = []
    for n, step, count, lead, head in map(C.unpack, blobs):
        parts.append((np.repeat(head, n), np.cumsum(step, dtype=np.int64), count.astype(np.int64), lead))
    if not parts:
        z = np.zeros(0, np.int64)
        return z.astype(U64), z, z, z
    rid, pos, count, lead = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(rid, kind="stable")
    return rid[order], pos[order], count[order], lead[order]


# --- 1: anchors -----------------------------------------------------------------------------------------------------


def _ship(plan: Plan, held: list[tuple], docs: list[tuple], buckets: int, doc_buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """What a batch's anchors come to: covered runs inside the batch as rows of kind -1 - COVERED, the rest by anchor."""
    doc_id, rid = (np.concatenate(x) for x in zip(*docs))
    doc, pos, count, lead, key, whole, left, right = (np.concatenate(x) for x in zip(*held))
    if not len(doc):
        return
    rank = np.argsort(np.argsort(doc_id, kind="stable"), kind="stable")
    order = np.lexsort((rank[doc], whole, key))
    doc, pos, count, lead, key, whole, left, right = (x[order] for x in (doc, pos, count, lead, key, whole, left, right))
    new = np.r_[True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    over = doc_id[doc] > doc_id[doc[first]]
    for b, _, blob in replies(rid[doc[over]], pos[over], count[over], lead[over], COVERED, doc_buckets):
        yield b, -1 - COVERED, blob
    keep = ~over
    doc, pos, count, lead, key, whole, left, right = (x[keep] for x in (doc, pos, count, lead, key, whole, left, right))
    order = np.lexsort((pos, doc))
    doc, pos, count, lead, key, whole, left, right = (x[order] for x in (doc, pos, count, lead, key, whole, left, right))
    for b, rows in C.split(C.bucket_of(key, buckets)):
        d = doc[rows]
        head = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        # of the anchor's hash the bucket has the high bits, 32 low ones go along; of the span's, 40
        yield b, 0, C.pack(
            [np.diff(np.r_[head, len(d)]).astype(np.int32), np.diff(pos[rows], prepend=0).astype(np.int32), count[rows].astype(np.uint8), lead[rows].astype(np.uint8), doc_id[d[head]]],
            [rid[d[head]], (key[rows] & U64(0xFFFFFFFF)).astype(np.uint32), (whole[rows] & U64(0xFFFFFFFF)).astype(np.uint32), (whole[rows] >> U64(56)).astype(np.uint8), left[rows], right[rows]],
        )


def _anchors(plan: Plan, buckets: int, doc_buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            held, docs, size, n = [], [], 0, 0
            for batch in batches:
                ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                rid = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
                data, off = C.text_bytes(batch.column(2))
                for i, j in C.text_runs(off):
                    h1, h2, o, _, _ = symbols(plan, data[off[i] : off[j]], off[i : j + 1] - off[i])
                    doc, *rest = spans(plan, h1, h2, o)
                    held.append((doc + n, *rest))
                    docs.append((ids[i:j], rid[i:j]))
                    n += j - i
                    size += int(off[j] - off[i])
                    if size >= COMBINE_BYTES:
                        yield from _ship(plan, held, docs, buckets, doc_buckets)
                        held, docs, size, n = [], [], 0, 0
            if held:
                yield from _ship(plan, held, docs, buckets, doc_buckets)

        yield from C.packed_batches(rows())

    return run


#: Records that a reducer sorts at once.
SORT_ROWS = 300_000


def _by_key(parts: list[tuple], key: int, total: int) -> Iterator[list[np.ndarray]]:
    """The rows of all parts (tuples of columns) in several goes, by the low bits of their column `key`."""
    goes = 1
    while goes * SORT_ROWS < total:
        goes *= 2
    for go in range(goes):
        mine = [p[key] & p[key].dtype.type(goes - 1) == go for p in parts] if goes > 1 else None
        cols = [np.concatenate([p[c][m] for p, m in zip(parts, mine)] if mine else [p[c] for p in parts]) for c in range(len(parts[0]))] if parts else []
        if cols and len(cols[0]):
            yield cols


def _meet(doc_buckets: int) -> Callable:
    """All records of an anchor: spans that a smaller document has, and spans to ask for."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0
        for kind, blob in rows:
            n, step, count, lead, ids, rid, key, w32, w8, left, right = C.unpack(blob)
            whole = (w32.astype(U64) << U64(24)) | (w8.astype(U64) << U64(16)) | (left.astype(U64) << U64(8)) | right
            parts.append((np.repeat(ids, n), np.repeat(rid, n), np.cumsum(step, dtype=np.int32), count, lead, key, whole))
            total += len(key)
        out = []
        for part in _by_key(parts, 5, total):
            out += meet_part(part)
        if out:
            yield from C.packed_batches(iter(joined(out)))

    def meet_part(part: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
        ids, rid, pos, count, lead, key, whole = part
        order = np.lexsort((ids, whole, key))
        ids, rid, pos, count, lead, key, whole = (x[order] for x in (ids, rid, pos, count, lead, key, whole))
        new = np.r_[True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        over = ids > ids[head][group]

        def shared(byte: np.ndarray) -> np.ndarray:
            """Of each group: whether another span of its anchor agrees on that side."""
            both = (key[head].astype(U64) << U64(8)) | byte
            _, back, times = np.unique(both, return_inverse=True, return_counts=True)
            return (times[back] > 1) & (byte > 0)

        ask = shared((whole[head] >> U64(8)) & U64(255)) | shared(whole[head] & U64(255))
        asked = ask[group] & ~over
        return [(rid[x], pos[x], count[x], lead[x], kind) for x, kind in ((over, COVERED), (asked, ASKED)) if x.any()]

    def joined(out: list[tuple]) -> Iterator[tuple[int, int, bytes]]:
        for kind in (COVERED, ASKED):
            if found := [x[:4] for x in out if x[4] == kind]:
                yield from replies(*(np.concatenate(x) for x in zip(*found)), kind, doc_buckets)

    return fn


# --- documents, packed by row ------------------------------------------------------------------------------------------


def _packed_docs(doc_buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                rid = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
                for b, at in C.split(C.bucket_of(rid, doc_buckets)):
                    part = batch.take(pa.array(at))
                    data, off = C.text_bytes(part.column(2))
                    carried = np.frombuffer(C.to_ipc(part.select(range(3, part.num_columns))) if part.num_columns > 3 else b"", np.uint8)
                    yield b, 9, C.pack([np.diff(off).astype(np.int64), data, carried, part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), part.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.uint8)], [rid[at]])

        yield from C.packed_batches(rows())

    return run


def _docs(blob: bytes, most: int = C.RUN_BYTES) -> Iterator[tuple]:
    """doc_id, whether it is null, rid, bytes, offsets and other columns (None: there are none), in runs."""
    size, data, carried, ids, null, rid = C.unpack(blob)
    rest = pa.ipc.open_stream(carried.tobytes()).read_next_batch() if len(carried) else None
    off = np.r_[0, np.cumsum(size)]
    for i, j in C.text_runs(off, most):
        yield ids[i:j], null[i:j], rid[i:j], data[off[i] : off[j]], off[i : j + 1] - off[i], rest and rest.slice(i, j - i)


def _of_rows(rid: np.ndarray, got: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The replies of each of these rows: row number, pos, count, lead."""
    lo, hi = np.searchsorted(got[0], rid, "left"), np.searchsorted(got[0], rid, "right")
    at = C.ranges(lo, hi - lo)
    return np.repeat(np.arange(len(rid)), hi - lo), got[1][at], got[2][at], got[3][at]


def _send_asked(plan: Plan, buckets: int) -> Callable:
    """The symbols of the spans asked for, by their anchors."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        asked, got, held, size = [], None, [], 0

        def out() -> Iterator[tuple[int, int, bytes]]:
            nonlocal got, size
            for kind, blob in rows:
                if kind == ASKED:
                    asked.append(blob)
                    continue
                got = got or read_replies(asked)
                if not len(got[0]):
                    return
                for ids, _, rid, data, off, _ in _docs(blob):
                    row, pos, count, lead = _of_rows(rid, got)
                    if not len(row):
                        continue
                    h1, _, o, start, end = symbols(plan, data, off)
                    s = o[row] + pos
                    e = s + count - 1 + plan.window
                    m = s + lead
                    key = C.mix(C.span_hash(C.prefix(h1), m, m + plan.k))
                    if plan.by_word:
                        s, e = start[s], end[e - 1]
                    held.append((ids[row], pos.astype(np.int32), count.astype(np.uint8), lead.astype(np.uint8), (e - s).astype(np.int32), data[C.ranges(s, e - s)], rid[row], key))
                    size += len(held[-1][5])
                    if size > 8 << 20:
                        yield from ship(held)
                        held.clear()
                        size = 0
            if held:
                yield from ship(held)

        def ship(held: list[tuple]) -> Iterator[tuple[int, int, bytes]]:
            ids, pos, count, lead, size, text, rid, key = (np.concatenate(x) for x in zip(*held))
            start = np.cumsum(size, dtype=np.int64) - size
            for b, at in C.split(C.bucket_of(key, buckets)):
                yield b, 0, C.pack([ids[at], pos[at], count[at], lead[at], size[at], text[C.ranges(start[at], size[at].astype(np.int64))]], [rid[at], key[at]])

        yield from C.packed_batches(out())

    return fn


def _settle(find: Callable, doc_buckets: int) -> Callable:
    """find(ids, count, lead, size, text, key) tells, for each window of each span in turn, whether a smaller document
    has it."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts, windows = [], 0
        for _, blob in rows:
            ids, pos, count, lead, size, text, rid, key = C.unpack(blob)
            parts.append((ids, pos, count, lead, size, rid, key, np.cumsum(size, dtype=np.int64) - size, np.full(len(ids), len(parts)), text))
            windows += int(count.sum()) + len(text) // 24  # beside a window's numbers, those of its symbols
        out = []
        for ids, pos, count, lead, size, rid, key, place, source in _by_key([p[:9] for p in parts], 6, windows):
            text = np.concatenate([parts[p][9][C.ranges(place[source == p], size[source == p].astype(np.int64))] for p in np.unique(source)])
            count = count.astype(np.int64)
            over = find(ids, count, lead.astype(np.int64), size.astype(np.int64), text, key)
            start = C.ranges(pos.astype(np.int64), count)[over]
            out.append((rid[np.repeat(np.arange(len(ids)), count)[over]], start))
        if any(len(x[0]) for x in out):
            rid, start = (np.concatenate(x) for x in zip(*out))
            yield from C.packed_batches(replies(rid, start, np.ones(len(start), np.int64), np.zeros(len(start), np.uint8), COVERED, doc_buckets))

    return fn


def _finish(plan: Plan, result: Callable) -> Callable:
    """result(ids, null, data, off, starts, ends, mask) makes the rows of some documents; mask tells of each symbol
    whether it is covered, by document in off2."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        covered, got = [], None
        for kind, blob in rows:
            if kind == COVERED:
                covered.append(blob)
                continue
            got = got or read_replies(covered)
            for ids, null, rid, data, off, rest in _docs(blob):
                if plan.by_word:
                    start, end, o = C.words(data, off)
                else:
                    start, end, o = off, off, off
                row, pos, count, _ = _of_rows(rid, got)
                s = o[row] + pos
                edge = np.bincount(s, minlength=o[-1] + 1) - np.bincount(s + count - 1 + plan.window, minlength=o[-1] + 1)
                out = result(pa.array(ids, pa.int64(), mask=null.astype(bool)), data, off, start, end, o, np.cumsum(edge[:-1]) > 0)
                if rest is not None:
                    out = pa.RecordBatch.from_arrays([*out.columns, *rest.columns], names=[*out.schema.names, *rest.schema.names])
                yield out

    return fn


def removed(docs: DataFrame, plan: Plan, find: Callable, result: Callable, schema: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each of docs (doc_id, text), made by `result`, with the columns `carry` of docs behind, as carried_0,
    carried_1, ..."""
    spark = docs.sparkSession
    n = C.partitions(spark)
    rows = C.has(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), C.row_id("doc_id", "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows
    kinds = T._parse_datatype_string(schema)
    if carry:
        own = [C.column(docs, c).alias(f"carried_{i}") for i, c in enumerate(carry)]
        whole = docs.select(docs["doc_id"].cast("long").alias("doc_id"), C.row_id("doc_id", "text").alias("rid"), F.coalesce(docs["text"], F.lit("")).alias("text"), *own)
        for i, c in enumerate(carry):
            kinds = kinds.add(f"carried_{i}", docs.schema[c].dataType)
    sent = _stored_runs(C.map_batches(rows, _anchors(plan, n, n), C.PACKED_SQL), n)
    packed = C.map_batches(whole, _packed_docs(n), C.PACKED_SQL)
    plain = C.map_batches(rows, _packed_docs(n), C.PACKED_SQL)
    asked = C.by_bucket(plain.unionByName(sent.where(F.col("kind") == ASKED)), _send_asked(plan, n), C.PACKED_SQL)
    fine = C.by_bucket(asked, _settle(find, n), C.PACKED_SQL)
    return C.by_bucket(packed.unionByName(sent.where(F.col("kind") == COVERED)).unionByName(fine), _finish(plan, result), kinds)


def _stored_runs(sent: DataFrame, n: int) -> DataFrame:
    """Runs that map tasks found and runs that anchors' meeting found, as a table. The first pass through the reducers
    as they are, in the same exchange: the anchors are computed once."""
    meet = _meet(n)

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        first: list = []

        def anchors() -> Iterator[tuple[int, bytes]]:
            for kind, blob in rows:
                if kind < 0:
                    first.append((bucket, -1 - kind, blob))
                    if sum(len(x[2]) for x in first[-64:]) > 4 << 20:
                        passed.append(C.packed_batch(first[:]))
                        first.clear()
                else:
                    yield kind, blob

        passed: list = []
        held = list(anchors())
        if first:
            passed.append(C.packed_batch(first))
        yield from passed
        if held:
            yield from meet(bucket, iter(held))

    return C.stored(C.by_bucket(sent, fn, C.PACKED_SQL), "runs")
