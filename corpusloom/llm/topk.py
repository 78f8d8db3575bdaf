"""Exact top-k inner products: columnar branch and bound over blocks of dimensions.

Components are turned into integers floor(scale * x). Queries are packed in blocks of bounded size, which are broadcast
one block at a time; every task keeps its candidates in vertical layout (a row for each dimension) and adds up partial
scores block of dimensions by block. What the dimensions still to come can add is bounded by the product of the two
vectors' remaining norms (Cauchy and Schwarz); candidates that can't reach a query's k-th best are dropped and the
survivors compacted before the next block. Ties go to the smaller id. Task results are merged by query.

Defined results: vectors that are null, or hold null or non-finite components, and rows without id take no part; only
vectors of one length are compared; a query isn't its own candidate, nor is another row with its id; repeated rows are
candidates each, and queries each; an empty table gives an empty result. Components beyond 2**20 in size are compared
without pruning in whole numbers; scores beyond 64 bits are out of range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

#: Queries of a broadcast block and of a group that is searched together; candidates of a block; dimensions of a block.
QUERY_BLOCK, GROUP, CANDIDATES, DIMS = 8192, 128, 8192, 16
EXACT = 1 << 20


def quantised(rows: DataFrame, scale: float = 256.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """vec_id and components as whole numbers, of the rows that take part, with the columns named."""
    x = F.transform("v", lambda a: a.cast("double"))
    fine = F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    return (
        rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].alias("v"), *[rows[c] for c in carry])
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
        .select("vec_id", F.transform(x, lambda a: F.floor(a * F.lit(scale))).alias("v"), *carry)
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and vectors, for each length of vectors."""
    ids, v = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    off = np.asarray(v.offsets).astype(np.int64)
    flat = v.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield ids[at], flat[C.ranges(off[at], size[at])].reshape(len(at), d)


def merge(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


class Search:
    """The best k candidates seen so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.q, self.k = ids, vectors, k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.exact = bool(len(vectors) and np.abs(vectors).max(initial=0) <= EXACT)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        d = rows.shape[1]
        if not self.exact or np.abs(rows).max(initial=0) > EXACT:
            for i in range(len(self.ids)):
                other = ids != self.ids[i]
                self.keep(i, rows[other] @ self.q[i], ids[other])
            return
        cols = np.ascontiguousarray(rows.T, np.float64)
        cuts = list(range(0, d, DIMS)) or [0]
        rest = lambda m: [np.sqrt((m[..., c + DIMS :] ** 2).sum(-1)) for c in cuts]
        mass = rest(rows.astype(np.float64))
        for g in range(0, len(self.ids), GROUP):
            q = self.q[g : g + GROUP].astype(np.float64)
            q_mass = rest(q)
            first = q[:, :DIMS] @ cols[:DIMS]
            for i in range(len(q)):
                own, (score, _) = self.ids[g + i], self.best[g + i]
                least = score[-1] if len(score) == self.k else -np.inf
                total = first[i]
                alive = np.flatnonzero((total + q_mass[0][i] * mass[0] * (1 + 1e-9) + 1 >= least) & (ids != own))
                total = total[alive]
                for n, c in enumerate(cuts[1:], 1):
                    if not len(alive):
                        break
                    block = cols[c : c + DIMS]
                    total = total + q[i, c : c + DIMS] @ (block if len(alive) == len(ids) else block[:, alive])
                    if least > -np.inf:
                        stay = total + q_mass[n][i] * mass[n][alive] * (1 + 1e-9) + 1 >= least
                        alive, total = alive[stay], total[stay]
                self.keep(g + i, total.astype(np.int64), ids[alive])

    def keep(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score) > 4 * self.k:  # all ties with the k-th stay
            least = np.partition(score, -self.k)[-self.k]
            score, ids = score[score >= least], ids[score >= least]
        if len(score):
            s, n = self.best[i]
            self.best[i] = merge(np.r_[s, score], np.r_[n, ids], self.k)


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            for ids, v in _matrices(batch):
                step = max(1, min(1024, (1 << 20) // max(1, v.shape[1])))
                for i in range(0, len(ids), step):
                    yield v.shape[1], 0, C.pack([ids[i : i + step], v[i : i + step].ravel()])

    yield from C.packed_batches(rows())


def _blocks(packed: DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of queries of one length, at most QUERY_BLOCK of them and about 64 MB."""
    held: dict[int, list] = {}
    for r in packed.toLocalIterator():
        d = r.bucket
        held.setdefault(d, []).append(C.unpack(bytes(r.blob)))
        n = sum(len(x[0]) for x in held[d])
        if n >= QUERY_BLOCK or n * max(1, d) * 8 >= 64 << 20:
            x = held.pop(d)
            yield d, np.concatenate([a for a, _ in x]), np.concatenate([b for _, b in x])
    for d, x in held.items():
        yield d, np.concatenate([a for a, _ in x]), np.concatenate([b for _, b in x])


def search(rows: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each row whose vec_id `every` divides."""
    vectors = quantised(rows, scale)
    spark = rows.sparkSession
    queries = C.stored(C.map_batches(vectors.where(F.col("vec_id") % every == 0), _pack_queries, C.PACKED_SQL), "queries")
    result = "query_id long, rank int, vec_id long, score long"
    out = None
    for n, (d, ids, flat) in enumerate(_blocks(queries)):
        block = spark.sparkContext.broadcast((d, ids, flat.reshape(len(ids), d)))
        part = C.stored(C.by_bucket(C.map_batches(vectors, _search(block, n, k), C.PACKED_SQL), _merge(k), result), "top")
        block.unpersist()
        out = part if out is None else out.unionByName(part)
        if n % 16 == 15:
            out = C.stored(out, "top")
    return spark.createDataFrame([], result) if out is None else out


def _search(block, number: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, q_ids, q = block.value
        job = Search(q_ids, q, k)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held += [(ids, v) for ids, v in _matrices(batch) if v.shape[1] == d]
            while sum(len(x[0]) for x in held) >= CANDIDATES:
                ids, v = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
                job.add(ids[:CANDIDATES], v[:CANDIDATES])
                held = [(ids[CANDIDATES:], v[CANDIDATES:])]
        if held:
            job.add(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))

        def rows() -> Iterator[tuple[int, int, bytes]]:
            for g in range(0, len(q_ids), GROUP):
                best = job.best[g : g + GROUP]
                yield number * (QUERY_BLOCK // GROUP) + g // GROUP, 0, C.pack([q_ids[g : g + GROUP], np.array([len(s) for s, _ in best], np.int32), np.concatenate([s for s, _ in best]), np.concatenate([i for _, i in best])])

        if held:
            yield from C.packed_batches(rows())

    return run


def _merge(k: int):
    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        best, q_ids = None, None
        for _, blob in rows:
            q_ids, n, score, ids = C.unpack(blob)
            cut = np.r_[0, np.cumsum(n)]
            best = best or [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q_ids)
            best = [merge(np.r_[s, score[a:b]], np.r_[i, ids[a:b]], k) for (s, i), a, b in zip(best, cut[:-1], cut[1:])]
        n = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(q_ids, n)), pa.array(np.concatenate([np.arange(1, m + 1) for m in n]).astype(np.int32)), pa.array(np.concatenate([i for _, i in best])), pa.array(np.concatenate([s for s, _ in best]))],
            names=["query_id", "rank", "vec_id", "score"],
        )

    return fn
