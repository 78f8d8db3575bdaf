"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by their extreme-value distribution.

fit() takes a bounded sample of labelled documents, one of each group of near copies, and counts for every word and every
prefix of it (PREFIXES bytes) the documents of each class that hold it. The log-odds of a prefix have a Dirichlet prior
centred on those of its next shorter prefix, and what parts them is shrunk by the strength of its evidence: by
1 - L^2 / G^2, with G^2 the likelihood ratio of the two and L^2 = c^2 2 ln(number of prefixes), which is what chance
alone reaches among so many (0 below that). So each token has log-odds, negative ones too: those of its longest prefix
that differs from the one before. c and the drift of a token without evidence are chosen by cross-validation among the
sample's rows, and the calibration is fitted on scores by models that haven't seen the row.

score() scans each text once for all maximal segments (Ruzzo and Tompa, 1999). A document's best segment, less the
logarithm of the document's length, follows a Gumbel law over clean documents; the tail probability under that law is
turned into the chance of label 1 by logistic regression.

Defined results: a null or empty text has no passages and the score of a text without any; a null doc_id is scored like
others and isn't held out; with labels of one class only, or none, all scores are 0; repeated rows each get their result;
other columns of any name are ignored (clean() keeps them); texts of any length are read whole, each by one task; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C
from ._labels import held_out, labelled_texts

#: Labelled rows that the model is fitted on at most.
SAMPLE_ROWS = 20_000
#: Bytes of the prefixes of a word that have log-odds, besides the word.
PREFIXES = (3, 4, 5, 6, 7, 8, 10)
#: Strength of the Dirichlet prior, in documents.
PRIOR = 1.0
FOLDS = 4
#: What cross-validation chooses from: the factor c of L, and the drift of a token.
FACTORS, DRIFTS = (0.6, 0.8, 1.0), (0.02, 0.08)
THRESHOLD = 0.3

_TOKEN_SEP = np.ones(256, bool)
_TOKEN_SEP[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = False


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z, and À to Þ in UTF-8, as small letters."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    after = np.r_[False, data[:-1] == 0xC3] & (data >= 0x80) & (data <= 0x9E) & (data != 0x97) if len(data) else np.zeros(0, bool)
    out[after] += 32
    return out


@dataclass
class Tokens:
    """The tokens of some texts: starts and ends in the bytes, the first token of each text, and prefix sums of hashes."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    pre: np.ndarray

    def levels(self, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of the tokens `at`, from the shortest prefix to the word: which have one of that length, and its hash."""
        size = self.end[at] - self.start[at]
        for n in PREFIXES:
            k = np.flatnonzero(size >= n)
            yield k, self._hash(at[k], self.start[at[k]] + n, n)
        yield np.arange(len(at)), self._hash(at, self.end[at], 255)

    def words(self) -> np.ndarray:
        return C.span_hash(self.pre, self.start, self.end)

    def _hash(self, at: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        return C.span_hash(self.pre, self.start[at], end) ^ C.T1[salt]


def tokens(data: np.ndarray, off: np.ndarray) -> Tokens:
    low = lower(data)
    spaced = low.copy()
    spaced[_TOKEN_SEP[low]] = 32
    return Tokens(*C.words(spaced, off), C.prefix(C.T1[low]))


def maximal_segments(at: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences: tokens `at` have `score`, every other token has -drift. First and last token,
    and the sum, of each. Linear in the number of scored tokens: each held segment knows the nearest earlier one with a
    smaller sum before it, so what a search has passed by isn't visited again."""
    total, last = 0.0, None
    held: list[list] = []  # first, last, sum before, sum after
    smaller: list[int] = []
    for p, s in zip(at.tolist(), score.tolist()):
        if last is not None:
            total -= drift * (p - last - 1)
        last = p
        if s <= 0:
            total += s
            continue
        k = [p, p, total, total + s]
        total += s
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= k[2]:
                j = smaller[j]
            if j < 0 or held[j][3] >= k[3]:
                break
            k = [held[j][0], k[1], held[j][2], k[3]]
            before = smaller[j]
            del held[j:], smaller[j:]
            j = before
        held.append(k)
        smaller.append(j)
    return [(a, b, r - l) for a, b, l, r in held]


@dataclass
class Model:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    drift: float = 0.02
    scale: float = 1.0
    place: float = 0.0
    spread: float = 1.0
    weights: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes have log-odds of their own, and those."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(48)).astype(np.int64)])
        if not len(self.words):
            return at[:0], self.odds[:0]
        i = np.minimum(np.searchsorted(self.words, h[at]), len(self.words) - 1)
        hit = self.words[i] == h[at]
        return at[hit], self.odds[i[hit]]

    def token_odds(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that have log-odds, and those."""
        odds = np.full(len(t.start), np.nan)
        every = np.arange(len(t.start))
        for k, h in t.levels(every):  # longer prefixes replace shorter ones
            hit, value = self.find(h)
            odds[k[hit]] = value
        at = np.flatnonzero(~np.isnan(odds))
        return at, odds[at]

    def passages(self, data: np.ndarray, off: np.ndarray, t: Tokens | None = None) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        """Length-corrected best score and segments (bytes in the text, sum of log-odds) of each text."""
        t = t or tokens(data, off)
        at, odds = self.token_odds(t)
        odds = odds - self.drift
        cut = np.searchsorted(at, t.first)
        n = np.diff(t.first)
        best = np.zeros(len(n))
        found: list[list[tuple[int, int, float]]] = [[]] * len(n)
        some = np.r_[0, np.cumsum(odds > 0)]
        for i in np.flatnonzero(some[cut[1:]] > some[cut[:-1]]):
            mine = slice(cut[i], cut[i + 1])
            seg = maximal_segments(at[mine], odds[mine], self.drift)
            best[i] = max(s for _, _, s in seg)
            found[i] = [(int(t.start[a] - off[i]), int(t.end[b] - off[i]), s) for a, b, s in seg]
        return self.scale * best - np.log(np.maximum(n, 1)), found

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """-log of the tail probability under the Gumbel law of clean documents."""
        z = np.exp(-np.clip((x - self.place) / self.spread, -30, 600))
        return -np.log(np.maximum(-np.expm1(-z), 1e-300))

    def chance(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        a, b, c = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * self.evidence(x) + c * np.log1p(n), -60, 60)))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, y, text and the least hash of three words running: near copies mostly share it."""
    for batch in batches:
        data, off = C.text_bytes(batch.column(2))
        for i, j in C.text_runs(off):
            part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            start, end, first = C.words(part, o)
            h, doc = C.word_hashes(part, start, end), np.repeat(np.arange(j - i), np.diff(first))
            least = np.full(j - i, np.iinfo(np.uint64).max, np.uint64)
            if len(h) >= 3:
                g = C.mix(C.grams(h, 3))
                at = np.flatnonzero(doc[: len(g)] == doc[2:])
                np.minimum.at(least, doc[at], g[at])
            few = np.flatnonzero(np.diff(first) < 3)
            least[few] = C.mix(C.span_hash(C.prefix(C.T1[part]), o[few], o[few + 1]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(3)), pa.array(least.view(np.int64))], names=["doc_id", "y", "text", "sketch"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each prefix its hash, that of the next shorter one, its level, and the documents that hold it by fold and class;
    all prefixes that begin alike go to one bucket."""
    held: list[tuple[np.ndarray, ...]] = []

    def combined() -> tuple[np.ndarray, ...]:
        h, parent, root, level, code, n = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((code, h))
        h, parent, root, level, code, n = (x[order] for x in (h, parent, root, level, code, n))
        head = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (code[1:] != code[:-1])])
        return h[head], parent[head], root[head], level[head], code[head], np.add.reduceat(n, head).astype(np.int32)

    for batch in batches:
        y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        code_of = ((y > 0) + 2 * fold).astype(np.uint8)
        data, off = C.text_bytes(batch.column(2))
        for i, j in C.text_runs(off):
            t = tokens(data[off[i] : off[j]], off[i : j + 1] - off[i])
            doc = np.repeat(np.arange(j - i), np.diff(t.first))
            last = np.zeros(len(doc), np.uint64)
            root = None
            for level, (k, h) in enumerate(t.levels(np.arange(len(doc)))):
                if root is None:
                    root = np.zeros(len(doc), np.uint64)
                    root[k] = h
                own = np.where(root[k] == 0, h, root[k])
                once = h + (doc[k] + 1).astype(np.uint64) * C.BASE  # once in each document
                _, u = np.unique(once, return_index=True)
                held.append((h[u], last[k[u]], own[u], np.full(len(u), level, np.uint8), code_of[i:j][doc[k[u]]], np.ones(len(u), np.int32)))
                last[k] = h
            if sum(len(x[0]) for x in held[-64:]) > 1 << 20:
                held = [combined()]
    if held and sum(len(x[0]) for x in held):
        h, parent, root, level, code, n = combined()
        yield from C.packed_batches((b, 0, C.pack([level[at], code[at], n[at]], [h[at], parent[at]])) for b, at in C.split(C.bucket_of(root, 64)))


def _totals(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """The counts of a bucket as one table, ordered by level; kind is the number of prefixes in two documents or more."""
    level, code, n, h, parent = (np.concatenate(x) for x in zip(*(C.unpack(b) for _, b in rows)))
    u, one, back = np.unique(h, return_index=True, return_inverse=True)
    table = np.bincount(back * (2 * FOLDS) + code, weights=n, minlength=len(u) * 2 * FOLDS).astype(np.int32).reshape(len(u), -1)
    keep = np.flatnonzero(table.sum(1) > 1)
    keep = keep[np.argsort(level[one[keep]], kind="stable")]
    yield C.packed_batch([(bucket, len(keep), C.pack([level[one[keep]], table[keep].ravel()], [u[keep], parent[one[keep]]]))])


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(p) - np.log1p(-p)


def _odds(label_counts: np.ndarray, prefixes: int):
    """Shrunken log-odds of the prefixes that differ from their next shorter one: for each model (a fold left out, or none:
    FOLDS) and factor. label_counts: labelled documents by fold and class."""
    limit = 2 * math.log(max(2, prefixes))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(2):
                level, table, h, parent = C.unpack(blob.as_py())
                table = table.reshape(-1, FOLDS, 2)
                order = np.argsort(h)
                above = order[np.minimum(np.searchsorted(h[order], parent), max(0, len(h) - 1))]
                has = h[above] == parent if len(h) else np.zeros(0, bool)
                for fold in range(FOLDS + 1):
                    rest = [f for f in range(FOLDS) if f != fold]
                    b, a = table[:, rest].sum(1).T.astype(float)
                    zeros, ones = label_counts[rest].sum(0)
                    base = _logit(np.array((ones + 0.5) / (zeros + ones + 1.0)))
                    for f, factor in enumerate(FACTORS):
                        odds, own = np.full(len(h), float(base)), np.zeros(len(h), bool)
                        for n in range(len(PREFIXES) + 1):
                            at = np.flatnonzero(level == n)
                            prior = np.where(has[at], odds[above[at]], base)
                            p = 1 / (1 + np.exp(-prior))
                            x, y = a[at], b[at]
                            new = _logit((x + PRIOR * p) / (x + y + PRIOR))
                            with np.errstate(divide="ignore", invalid="ignore"):
                                g = 2 * (np.where(x > 0, x * np.log(x / ((x + y) * p)), 0) + np.where(y > 0, y * np.log(y / ((x + y) * (1 - p))), 0))
                                keep = np.where(g > 0, np.maximum(0, 1 - factor**2 * limit / g), 0)
                            odds[at] = prior + np.where(keep > 0, keep * (new - prior), 0)
                            own[at] = keep > 0
                        k = np.flatnonzero(own)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), fold), pa.int32()), pa.array(np.full(len(k), f), pa.int32()), pa.array(h[k].view(np.int64)), pa.array(odds[k] - base), pa.array(b[k] / max(1.0, zeros))], names=["fold", "factor", "h", "odds", "rate"])

    return fn


def _scale(odds: np.ndarray, rate: np.ndarray, drift: float, size: float) -> float:
    """Karlin and Altschul's: the positive root of sum p exp(scale s) = 1 over a clean text's tokens."""
    p = rate / max(1.0, size)
    lo, hi = 1e-3, 5.0
    for _ in range(60):
        mid = (lo + hi) / 2
        value = (p * np.exp(np.minimum(mid * (odds - drift), 500))).sum() + (1 - min(0.5, p.sum())) * math.exp(-mid * drift)
        lo, hi = (mid, hi) if value < 1 else (lo, mid)
    return max(lo, 0.2)


def _features(models: dict[int, list[Model]]):
    """y, and the best score and the number of segments by each of the models that haven't seen the row's fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column(1).to_numpy(zero_copy_only=False)
            data, off = C.text_bytes(batch.column(2))
            for i, j in C.text_runs(off):
                part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                t = tokens(part, o)
                x, n = np.zeros((j - i, len(models[0]))), np.zeros((j - i, len(models[0])))
                for f in np.unique(fold[i:j]):
                    mine = fold[i:j] == f
                    for m, model in enumerate(models[int(f)]):
                        got, found = model.passages(part, o, t)
                        x[mine, m], n[mine, m] = got[mine], np.array([len(s) for s in found], float)[mine]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(n.tolist(), pa.list_(pa.float64()))], names=["y", "x", "n"])

    return run


def _calibrated(model: Model, y: np.ndarray, x: np.ndarray, n: np.ndarray) -> float:
    """Sets the model's Gumbel law and weights; returns the mean log loss."""
    clean = x[y == 0]
    model.spread = max(0.05, float(clean.std()) * math.sqrt(6) / math.pi)
    model.place = float(clean.mean()) - 0.5772 * model.spread
    f = np.stack([np.ones(len(y)), model.evidence(x), np.log1p(n)], 1)
    w = np.zeros(3)
    for _ in range(40):  # Newton's steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        w += np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + 1e-2 * np.eye(3), f.T @ (y - q) - 1e-2 * w)
    model.weights = tuple(map(float, w))
    q = np.clip(model.chance(x, n), 1e-6, 1 - 1e-6)
    return float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    texts = C.stored(C.map_batches(labelled_texts(docs, labels, "toxic", rows)[0], _sketches, "doc_id long, y int, text string, sketch long"), "labelled")
    # one row of each group of near copies: copies are no further evidence
    one = texts.groupBy("sketch", "y").agg(F.min("doc_id").alias("doc_id")).toPandas().sort_values(["doc_id", "sketch", "y"]).drop_duplicates("doc_id")
    one["fold"] = (C.mix(one["sketch"].to_numpy(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int)
    label_counts = np.array([[((one["fold"] == f) & (one["y"] > 0).eq(bool(c))).sum() for c in (0, 1)] for f in range(FOLDS)])
    if not label_counts.sum(0).all():
        return Model()
    ids = docs.sparkSession.createDataFrame([(int(d), int(f)) for d, f in zip(one["doc_id"], one["fold"])], "id long, fold int")
    texts = texts.join(F.broadcast(ids), texts["doc_id"] == ids["id"]).select("y", "fold", "text")
    table = C.stored(C.by_bucket(C.map_batches(texts, _counts, C.PACKED_SQL), _totals, C.PACKED_SQL), "counts")
    prefixes = table.agg(F.sum("kind")).first()[0] or 0
    got = C.map_batches(table, _odds(label_counts, prefixes), "fold int, factor int, h long, odds double, rate double").toPandas()
    models: dict[int, list[Model]] = {}
    for fold in range(FOLDS + 1):
        models[fold] = []
        for factor in range(len(FACTORS)):
            mine = got[(got["fold"] == fold) & (got["factor"] == factor)].sort_values("h", key=lambda s: s.to_numpy(np.int64).view(np.uint64))
            words, odds, rate = mine["h"].to_numpy(np.int64).view(np.uint64), mine["odds"].to_numpy(float), mine["rate"].to_numpy(float)
            models[fold] += [Model(words, odds, drift, _scale(odds, rate, drift, 300.0)) for drift in DRIFTS]
    unseen = C.map_batches(texts, _features({f: models[f] for f in range(FOLDS)}), "y int, x array<double>, n array<double>").toPandas()
    y, x, n = (unseen["y"] > 0).to_numpy(float), np.stack(unseen["x"].to_list()), np.stack(unseen["n"].to_list())
    loss = [_calibrated(m, y, x[:, i], n[:, i]) for i, m in enumerate(models[FOLDS])]
    return models[FOLDS][int(np.argmin(loss))]


RESULT = "doc_id long, score double, passages array<struct<start:int,end:int,log_odds:double>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and passages (byte ranges of the text and their sums) of each of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("log_odds", pa.float64())]))
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for i, j in C.text_runs(off):
                x, found = model.passages(data[off[i] : off[j]], off[i : j + 1] - off[i])
                chance = model.chance(x, np.array([len(f) for f in found], float))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(chance), pa.array([[{"start": a, "end": b, "log_odds": s} for a, b, s in f] for f in found], kind)], names=["doc_id", "score", "passages"])

    out = C.map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")), run, RESULT)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, whose score is under the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = C.text_bytes(batch.column(batch.schema.get_field_index("text")))
            for i, j in C.text_runs(off):
                x, found = model.passages(data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield batch.slice(i, j - i).filter(pa.array(model.chance(x, np.array([len(f) for f in found], float)) < THRESHOLD))

    return C.map_batches(docs, run, docs.schema)
