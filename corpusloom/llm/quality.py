"""Quality classifier: random-indexing term vectors pooled by document, a two-layer network, calibrated temperature.

A word gives two terms: its hash and its shape (letter case, punctuation, length, whether it repeats the word before).
Random indexing gives every term a sparse random index vector; a term's vector is the sum of the index vectors of the
terms around it, over a bounded sample of labelled documents, scaled to length one. A document's features are the means
of its words' and of its shapes' vectors, the shares of some shape traits, and the logarithm of its length. A network of
two layers in numpy is fitted on most of the sample; the rest sets the temperature of its probabilities.

Defined results: a null or empty text has zero features and gets a score like others; a null doc_id is scored and isn't
held out; with labels of one class only, all scores are that label; repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C
from ._labels import held_out, labelled_texts

SAMPLE_ROWS = 12_000
DIMS = 32
WORD_ROWS = 1 << 14
SHAPE_ROWS = 1 << 11
HIDDEN = 24
THRESHOLD = 0.7
_ROWS = WORD_ROWS + SHAPE_ROWS


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors: four entries of +1 or -1 for each term, by hash."""
    out = np.zeros((_ROWS, DIMS), np.float32)
    row = np.arange(_ROWS)
    for k in range(4):
        h = C.mix((row.astype(np.uint64) + np.uint64(1)) * C.BASE + np.uint64(k))
        out[row, (h % np.uint64(DIMS)).astype(np.int64)] += np.where(h >> np.uint64(63), 1, -1)
    return out


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word term, shape term and traits (columns) of each word, and the number of the first word of each text."""
    start, end, first = C.words(data, off)
    h = C.word_hashes(data, start, end)
    n = end - start
    count = lambda m: (lambda c: c[end] - c[start])(np.r_[0, np.cumsum(m[data], dtype=np.int32)])
    upper, alpha, digit = count(_UPPER), count(_ALPHA), count(_DIGIT)
    other = n - alpha - digit
    again = np.r_[False, h[1:] == h[:-1]] if len(h) else np.zeros(0, bool)
    again[first[first < len(h)]] = False
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    shouted, marked, bare = (upper >= 2) & (upper * 2 > alpha), other >= 2, alpha + digit == 0
    shape = np.minimum(n, 15) | (again << 4) | (shouted << 5) | (np.minimum(other, 3) << 6) | (bare << 8) | ((digit > 0) << 9) | (((last < 48) | (last > 57) & (last < 65)) << 10)
    traits = np.stack([again, shouted, marked, bare, digit > 0, np.minimum(n, 30) / 10], 1).astype(np.float32) if len(n) else np.zeros((0, 6), np.float32)
    return (h % np.uint64(WORD_ROWS)).astype(np.int64), WORD_ROWS + shape.astype(np.int64), traits, first


def pooled(table: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    word, shape, traits, first = terms(data, off)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIMS + 7), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        at = first[:-1][some]
        for k, x in ((0, table[word]), (DIMS, table[shape]), (2 * DIMS, traits)):
            out[some, k : k + x.shape[1]] = np.add.reduceat(x, at, axis=0) / n[some, None]
    out[:, -1] = np.log1p(n) / 5
    return out


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each term, of one task."""
    total, index, some = np.zeros((_ROWS, DIMS), np.float32), index_vectors(), False
    for batch in batches:
        data, off = C.text_bytes(batch.column(1))
        for i, j in C.text_runs(off):
            word, shape, _, first = terms(data[off[i] : off[j]], off[i : j + 1] - off[i])
            doc = np.repeat(np.arange(j - i), np.diff(first))
            around = index[word] + index[shape]
            for gap in (1, 2):
                near = np.flatnonzero(doc[gap:] == doc[:-gap])
                for here, there in ((near, near + gap), (near + gap, near)):
                    for term in (word, shape):
                        order = np.argsort(term[here], kind="stable")
                        t = term[here][order]
                        cut = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
                        if len(cut):
                            total[t[cut]] += np.add.reduceat(around[there][order], cut, axis=0)
            some = True
    if some:
        yield C.packed_batch([(0, 0, C.pack([total.ravel()]))])


def _sum(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_ROWS * DIMS, np.float32)
    for _, blob in rows:
        total += C.unpack(blob)[0]
    yield C.packed_batch([(0, 0, C.pack([total]))])


@dataclass
class Model:
    table: np.ndarray
    layers: tuple[np.ndarray, ...] | None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0
    constant: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ a + b) @ c + d

    def chance(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = 600) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray, float]:
    """Layers, the features' means and scales, and the temperature that the last fifth of the rows asks for."""
    r = np.random.default_rng(seed)
    order = r.permutation(len(y))
    x, y = x[order], y[order].astype(np.float32)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    cut = max(1, len(y) * 4 // 5)
    layers = [r.normal(0, 0.2, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), r.normal(0, 0.2, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers]
    for step in range(1, steps + 1):
        at = r.integers(0, cut, min(cut, 512))
        u, t = x[at], y[at]
        hid = np.tanh(u @ layers[0] + layers[1])
        err = (1 / (1 + np.exp(-np.clip(hid @ layers[2] + layers[3], -30, 30))) - t) / len(t)
        back = np.outer(err, layers[2]) * (1 - hid * hid)
        for k, g in enumerate((u.T @ back + 1e-4 * layers[0], back.sum(0), hid.T @ err + 1e-4 * layers[2], err.sum())):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            layers[k] = layers[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    rest = slice(cut, None) if cut < len(y) else slice(None)
    logit = np.tanh(x[rest] @ layers[0] + layers[1]) @ layers[2] + layers[3]
    loss = lambda t: np.mean(np.logaddexp(0, np.where(y[rest] > 0, -logit, logit) / t))
    return tuple(layers), mean, scale, float(min(np.geomspace(0.3, 10, 60), key=loss))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    texts, zeros, ones = labelled_texts(docs, labels, "quality", rows)
    texts = texts.select("y", "text")
    table = np.zeros((_ROWS, DIMS), np.float32)
    if not zeros or not ones:
        return Model(table, None, constant=float(ones > 0))
    few = texts.coalesce(max(1, min(16, C.partitions(docs.sparkSession))))  # so many tables are summed
    for r in C.by_bucket(C.map_batches(few, _context, C.PACKED_SQL), _sum, C.PACKED_SQL).toLocalIterator():
        table = C.unpack(bytes(r.blob))[0].reshape(_ROWS, DIMS).copy()
    table /= np.linalg.norm(table, axis=1, keepdims=True) + 1e-6

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for i, j in C.text_runs(off):
                x = pooled(table, data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield C.packed_batch([(0, 0, C.pack([batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.int32), x.ravel()]))])

    got = [C.unpack(bytes(r.blob)) for r in C.map_batches(texts, features, C.PACKED_SQL).toLocalIterator()]
    if not got:
        return Model(table, None, constant=1.0)
    y, x = np.concatenate([g[0] for g in got]) > 0, np.concatenate([g[1] for g in got]).reshape(-1, 2 * DIMS + 7)
    order = np.lexsort((x[:, -1], x[:, 0], x[:, 1], y))  # the same sample gives the same model, however tasks end
    return Model(table, *train(x[order], y[order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for i, j in C.text_runs(off):
                chance = model.chance(pooled(model.table, data[off[i] : off[j]], off[i : j + 1] - off[i]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(chance.astype(float))], names=["doc_id", "score"])

    out = C.map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")), run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
