"""Hard-negative mining by dual-tree search over anchors and candidates.

Components are whole numbers floor(scale * x), so scores are exact. Tasks build ball trees (split at the median of the widest
dimension, by label first where labels are few): one over each block of anchors, one over each block of candidates that a
task reads. For a pair of nodes with centres p, q and radii r, s all inner products lie in p.q +- (|p| s + |q| r + r s). A
pair is left, with all its anchors at once, when its interval can't reach what any anchor of the node still looks for: its
k-th best positive so far, or any of its windows [share * positive, positive] above that window's k-th best negative. Pairs
of leaves are scored exactly. Anchors are a stated set of queries: they go to the tasks in waves of bounded size, each a
scan of the candidates whose broadcast is dropped before the next; a wave's positives are merged and stored, then a second
scan finds its negatives.

Defined results: rows whose id, label or vector is null, or whose vector holds null or non-finite components, take no part; only
vectors of one length are compared; a row is never a positive or negative of an anchor of its own id; repeated rows are
candidates each, and anchors each; ties go to the smaller id; an anchor without positives, or a positive without negatives,
has no row; an empty table gives an empty result; extra columns have no influence. Components beyond 2**20 in size are
compared without pruning in whole numbers; scores beyond 2**53 are out of range.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C
from .topk import EXACT, quantised

#: Rows of a block and of a leaf, for anchors and candidates; bytes of anchors in a wave.
ANCHORS, CANDIDATES, ANCHOR_LEAF, LEAF = 4096, 8192, 32, 256
WAVE_BYTES = 32 << 20
#: Up to so many labels a tree's first split is by label.
LABELS = 32


class Tree:
    """Rows in tree order; node i covers rows begin[i]:end[i], with left[i] and left[i] + 1 below it, or -1."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, leaf: int) -> None:
        by_label = np.argsort(labels, kind="stable")
        ids, labels, self.rows = ids[by_label], labels[by_label], rows[by_label]
        order = np.arange(len(ids))
        cut = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
        roots = list(zip(cut, np.r_[cut[1:], len(ids)])) if len(cut) <= LABELS else [(0, len(ids))]
        self.roots = list(range(len(roots)))
        self.exact = bool(np.abs(rows).max(initial=0) <= EXACT)
        todo, left = list(roots), []
        for a, b in todo:  # grows while it is read
            left.append(-1)
            if self.exact and b - a > leaf:
                x = self.rows[order[a:b]]
                axis = int(np.argmax(np.ptp(x, axis=0)))
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(x[:, axis], half)]
                left[-1] = len(todo)
                todo += [(a, a + half), (a + half, b)]
        self.ids, self.labels, self.rows = ids[order], labels[order], np.ascontiguousarray(self.rows[order])
        self.begin, self.end = (np.array([x[i] for x in todo], np.int64) for i in (0, 1))
        self.left = np.array(left, np.int64)
        if not self.exact:
            return
        self.rows = self.rows.astype(np.float64)
        self.centre = np.stack([self.rows[a:b].mean(0) for a, b in todo])
        self.radius = np.array([np.sqrt(((self.rows[a:b] - c) ** 2).sum(1).max()) for (a, b), c in zip(todo, self.centre)])
        self.norm = np.sqrt((self.centre**2).sum(1))
        span = [(self.labels[a:b].min(), self.labels[a:b].max()) for a, b in todo]
        self.label = [int(x) if x == y else None for x, y in span]


def first_k(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(head, np.diff(np.r_[head, len(g)]))
    return order[rank < k]


class Search:
    """The k best candidates so far in each of an anchor's windows [low, high]; rows are anchors, columns windows."""

    def __init__(self, tree: Tree, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> None:
        self.tree, self.low, self.high, self.k, self.same = tree, low, high, k, same
        self.floor = low.copy()  # what a candidate must reach: the window's foot, or its k-th best so far
        empty = np.zeros(0, np.int64)
        self.best = (empty, empty, empty)  # window (anchor * windows + column), score, id

    def add(self, other: Tree) -> None:
        if self.tree.rows.shape[1] != other.rows.shape[1]:
            return
        if not (self.tree.exact and other.exact):
            whole = lambda t: t.rows.astype(np.int64)
            for a in range(len(self.tree.ids)):
                self._score(a, a + 1, whole(self.tree)[a : a + 1] @ whole(other).T, other, 0, len(other.ids))
            return
        self._pairs(other, [(a, c) for a in self.tree.roots for c in other.roots])

    def _interval(self, other: Tree, a: int, c: int) -> tuple[float, float]:
        t = self.tree
        mid = float(t.centre[a] @ other.centre[c])
        width = (t.norm[a] * other.radius[c] + other.norm[c] * t.radius[a] + t.radius[a] * other.radius[c]) * (1 + 1e-9) + abs(mid) * 1e-9 + 1
        return mid - width, mid + width

    def _pairs(self, other: Tree, pairs: list[tuple[int, int]]) -> None:
        """Best first: the pair whose interval ends highest is next, so that thresholds rise early."""
        t, todo = self.tree, []

        def push(a: int, c: int) -> None:
            x, y = t.label[a], other.label[c]
            if x is None or y is None or (x == y) == self.same:
                least, most = self._interval(other, a, c)
                heapq.heappush(todo, (-most, a, c, least))

        for a, c in pairs:
            push(a, c)
        while todo:
            most, a, c, least = heapq.heappop(todo)
            rows = slice(t.begin[a], t.end[a])
            if not ((self.floor[rows] <= -most) & (self.high[rows] >= least) & (self.floor[rows] <= self.high[rows])).any():
                continue
            below_a, below_c = t.left[a], other.left[c]
            if below_a < 0 and below_c < 0:
                self._score(t.begin[a], t.end[a], t.rows[rows] @ other.rows[other.begin[c] : other.end[c]].T, other, other.begin[c], other.end[c])
            elif below_c >= 0 and (below_a < 0 or other.radius[c] >= t.radius[a]):
                push(a, below_c)
                push(a, below_c + 1)
            else:
                push(below_a, c)
                push(below_a + 1, c)

    def _score(self, a: int, b: int, score: np.ndarray, other: Tree, c: int, d: int) -> None:
        fit = (self.tree.labels[a:b, None] == other.labels[None, c:d]) == self.same
        fit &= self.tree.ids[a:b, None] != other.ids[None, c:d]
        n = self.low.shape[1]
        found = []
        for w in range(n):
            i, j = np.nonzero(fit & (score >= self.floor[a:b, w, None]) & (score <= self.high[a:b, w, None]))
            if len(i):
                found.append(((a + i) * n + w, score[i, j].astype(np.int64), other.ids[c + j]))
        if not found:
            return
        new = [np.concatenate(x) for x in zip(*found)]
        own = (self.best[0] >= a * n) & (self.best[0] < b * n)
        group, s, ids = (np.r_[o[own], x] for o, x in zip(self.best, new))
        keep = first_k(group, s, ids, self.k)
        group, s, ids = group[keep], s[keep], ids[keep]
        self.best = tuple(np.r_[o[~own], x] for o, x in zip(self.best, (group, s, ids)))
        full, at = np.unique(group, return_index=True)
        last = np.r_[at[1:], len(group)] - 1
        done = last - at + 1 == self.k
        self.floor[full[done] // n, full[done] % n] = np.maximum(self.low[full[done] // n, full[done] % n], s[last[done]])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and vectors, for each length of vectors."""
    ids, labels, v = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
    off = np.asarray(v.offsets).astype(np.int64)
    flat = v.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield ids[at], labels[at], flat[C.ranges(off[at], size[at])].reshape(len(at), d)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of at most so many rows, each of vectors of one length."""
    held: dict[int, list] = {}
    for batch in batches:
        for part in _matrices(batch):
            d = part[2].shape[1]
            held.setdefault(d, []).append(part)
            while sum(len(x[0]) for x in held[d]) >= most:
                whole = [np.concatenate(x) for x in zip(*held[d])]
                yield tuple(x[:most] for x in whole)
                held[d] = [tuple(x[most:] for x in whole)]
    for parts in held.values():
        block = tuple(np.concatenate(x) for x in zip(*parts))
        if len(block[0]):
            yield block


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from C.packed_batches((v.shape[1], len(ids), C.pack([ids, labels, v.ravel()])) for ids, labels, v in _blocks(batches, ANCHORS))


def _found(k: int, same: bool, wave):
    """The best of a task's candidates for each anchor block of the wave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs = []
        for number, (ids, labels, rows, low, high) in wave.value.items():
            tree = Tree(np.arange(len(ids)), labels, rows, ANCHOR_LEAF)  # its ids are places in the block
            place = tree.ids
            tree.ids = ids[place]
            jobs.append((number, place, Search(tree, low[place], high[place], k, same)))
        for ids, labels, rows in _blocks(batches, CANDIDATES):
            other = Tree(ids, labels, rows, LEAF)
            for _, _, job in jobs:
                job.add(other)

        def out() -> Iterator[tuple[int, int, bytes]]:
            for number, place, job in jobs:
                window, score, ids = job.best
                n = job.low.shape[1]
                if len(window):
                    yield number, 0, C.pack([place[window // n] * n + window % n, score, ids, job.tree.ids[window // n]])

        yield from C.packed_batches(out())

    return run


def _merged(k: int):
    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64),) * 4
        for _, blob in rows:
            best = tuple(np.r_[x, y] for x, y in zip(best, C.unpack(blob)))
            keep = first_k(*best[:3], k)
            best = tuple(x[keep] for x in best)
        window, score, ids, anchor = best
        head = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        rank = np.arange(len(window)) - np.repeat(head, np.diff(np.r_[head, len(window)])) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(window), bucket), pa.int32()), *(pa.array(x, pa.int64()) for x in (window, rank, score, ids, anchor))], names=["block", "place", "rank", "score", "vec_id", "anchor_id"])

    return fn


BEST = "block int, place long, rank long, score long, vec_id long, anchor_id long"


def _searched(rows: DataFrame, wave: dict[int, tuple], k: int, same: bool, name: str) -> DataFrame:
    """A scan of rows for a wave, stored; its broadcast goes."""
    sent = rows.sparkSession.sparkContext.broadcast(wave)
    found = C.stored(C.by_bucket(C.map_batches(rows, _found(k, same, sent), C.PACKED_SQL), _merged(k), BEST), name)
    sent.unpersist()
    return found


def _waves(packed: DataFrame) -> Iterator[dict[int, tuple]]:
    """Anchor blocks by number, about WAVE_BYTES at a time."""
    wave, size = {}, 0
    for number, r in enumerate(packed.toLocalIterator()):
        ids, labels, flat = C.unpack(bytes(r.blob))
        wave[number] = (ids, labels, flat.reshape(len(ids), r.bucket))
        size += flat.nbytes + 160 * len(ids)
        if size >= WAVE_BYTES:
            yield wave
            wave, size = {}, 0
    if wave:
        yield wave


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, label, every: int = 100, positives: int = 5, negatives: int = 5, share: int = 80, scale: float = 256.0) -> DataFrame:
    """For each row whose vec_id `every` divides and each of its first positives (same label): the first rows of another
    label whose score is between `share` percent of the positive's and the positive's. `label` is an expression over rows."""
    spark = rows.sparkSession
    labelled = rows.select(rows["vec_id"], rows["embedding"], F.struct(label.cast("long").alias("label")).alias("kept")).where("kept.label IS NOT NULL")
    whole = quantised(labelled, scale, carry=("kept",)).select("vec_id", F.col("kept.label").alias("label"), "v")
    packed = C.stored(C.map_batches(whole.where(F.col("vec_id") % every == 0), _pack_anchors, C.PACKED_SQL), "anchors")
    out = None
    for number, wave in enumerate(_waves(packed)):
        open_ = {b: (*x, np.full((len(x[0]), 1), -np.inf), np.full((len(x[0]), 1), np.inf)) for b, x in wave.items()}
        best = _searched(whole, open_, positives, True, "positives")
        score = {b: np.full((2, len(x[0]), positives), np.nan) for b, x in wave.items()}
        for r in best.toLocalIterator():  # at most `positives` rows an anchor of this wave
            score[r.block][0][r.place, r.rank - 1] = -((-share * r.score) // 100)
            score[r.block][1][r.place, r.rank - 1] = r.score
        closed = {b: (*x, np.where(np.isnan(score[b][0]), np.inf, score[b][0]), np.where(np.isnan(score[b][1]), -np.inf, score[b][1])) for b, x in wave.items()}
        worst = _searched(whole, closed, negatives, False, "negatives")
        place = (F.col("place") * positives + F.col("rank") - 1).alias("place")
        pairs = best.select("block", place, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        part = pairs.join(worst, ["block", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = part if out is None else out.unionByName(part)
        if number % 16 == 15:
            out = C.stored(out, "hard-negatives")
    return spark.createDataFrame([], RESULT) if out is None else out
