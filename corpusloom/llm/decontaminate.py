"""Benchmark decontamination: a BM25 index of the test items, searched by block-max WAND with every passage as a query.

Test items are indexed in blocks of bounded size (items and bytes), each of which is broadcast by itself; document
frequencies and mean length are those of the whole benchmark, so a score doesn't depend on the blocks. Impacts are
normalised by the score that an item gets for its own words, so one threshold means "so much of the item's weight".
Every document is cut into overlapping windows, by the length of an item and not by what else the benchmark holds: for an
item of n words they begin every s words, the least power of two from 2 n on, and have 2 s words, so an item whose words
lie within s words is in a window whole. Items of one s are an index; a scan goes through those of a block together. Terms are parted in essential ones and the rest, whose impacts
can't reach half the threshold for any item: a window whose essential terms can't make up the other half is passed over
(that is WAND's bound, taken for all windows at once); the others run block-max WAND, which retrieves every item at or
above the threshold. A retrieved item is then verified: enough n-grams of its question (all sentences but the last) and
of its answer (the last; the last third of the words if there is one sentence) must occur in the window.

Words are compared without case and punctuation. Defined results: null texts and ids take no part, items without words
match nothing; documents of no words match nothing; repeated rows of documents give a row each; of repeated items each
row counts; an empty benchmark or table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C
from .toxicity import tokens

U64 = np.uint64
K1, B = 1.2, 0.75
#: Retrieval: share of an item's own score. Verification: shares of n-grams of question and answer.
THRESHOLD, QUESTION, ANSWER, NGRAM = 0.6, 0.7, 0.5, 3
#: Items of an index block and bytes of their texts: what is broadcast at once.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 8 << 20
POSTINGS = 32
_END = 1 << 60


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    return np.unique(C.grams(h, min(n, len(h)))) if len(h) else np.zeros(0, U64)


@dataclass
class Statistics:
    """Of all items: their number and words, and the items of each word (sorted hashes)."""

    items: int = 0
    words: int = 0
    term: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, texts: list[str]) -> None:
        found = [h for h in map(_words, texts) if len(h)]
        if found:
            self.items += len(found)
            self.words += sum(map(len, found))
            own, n = np.unique(np.concatenate([np.unique(h) for h in found]), return_counts=True)
            self.term, back = np.unique(np.concatenate([self.term, own]), return_inverse=True)
            self.df = np.bincount(back, weights=np.concatenate([self.df, n]), minlength=len(self.term)).astype(np.int64)

    def of(self, term: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.term, term)]


def _words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return tokens(raw, np.array([0, len(raw)])).words()


def stride(n: int) -> int:
    """How far apart the windows for an item of n words begin."""
    return 1 << (2 * n - 1).bit_length()


@dataclass
class Index:
    """Postings of some items; the windows are those of the longest. term: sorted hashes. lists: for each term, items and impacts, with the largest
    impact of each run of POSTINGS postings."""

    ids: list[int]
    question: list[np.ndarray]
    answer: list[np.ndarray]
    term: np.ndarray
    bound: np.ndarray
    essential: np.ndarray
    lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    window: int
    spare: float

    @staticmethod
    def of(items: list[tuple[int, str]], whole: Statistics | None = None) -> Index:
        """whole: statistics of the benchmark that the items are a block of; without, they are all of it."""
        if whole is None:
            whole = Statistics()
            whole.add([text for _, text in items])
        ids, question, answer, words = [], [], [], []
        for i, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            t = tokens(raw, np.array([0, len(raw)]))
            end, h = t.end, t.words()
            if not len(h):
                continue
            ends = [m.end() for m in re.finditer(rb"[.!?](?=\s)", text.strip().encode())]
            cut = int(np.searchsorted(end, ends[-1], "right")) if ends else 0
            if not 0 < cut < len(h):
                cut = max(1, len(h) * 2 // 3)
            ids.append(i)
            question.append(_grams(h[:cut], NGRAM))
            answer.append(_grams(h[cut:], NGRAM))
            words.append(h)
        n = len(ids)
        if not n:
            z = np.zeros(0)
            return Index([], [], [], z.astype(U64), z, z.astype(bool), [], 1, 0.0)
        size = np.array([len(h) for h in words])
        item = np.repeat(np.arange(n), size)
        term, back = np.unique(np.concatenate(words), return_inverse=True)
        pair, tf = np.unique(back * np.int64(n) + item, return_counts=True)
        t, i = pair // n, pair % n
        df = np.bincount(t, minlength=len(term))
        everywhere = whole.of(term)
        idf = np.log1p((whole.items - everywhere + 0.5) / (everywhere + 0.5))
        impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[i] * whole.items / whole.words))
        impact /= np.bincount(i, weights=impact, minlength=n)[i]
        head = np.r_[np.flatnonzero(np.r_[True, t[1:] != t[:-1]]), len(t)]
        bound = np.maximum.reduceat(impact, head[:-1])
        essential = np.ones(len(term), bool)
        loose = np.zeros(n)
        for k in np.argsort(-df, kind="stable"):
            mine = slice(head[k], head[k + 1])
            if (loose[i[mine]] + impact[mine]).max() > THRESHOLD / 2:
                break
            loose[i[mine]] += impact[mine]
            essential[k] = False
        lists = [(i[a:b], impact[a:b], np.maximum.reduceat(impact[a:b], np.arange(0, b - a, POSTINGS))) for a, b in zip(head[:-1], head[1:])]
        return Index(ids, question, answer, term, bound, essential, lists, stride(int(size.max())), float(loose.max()))

    def __post_init__(self) -> None:
        self.head = np.r_[0, np.cumsum([len(x[0]) for x in self.lists])].astype(np.int64)
        self.items = np.concatenate([x[0] for x in self.lists]) if self.lists else np.zeros(0, np.int64)
        self.impacts = np.concatenate([x[1] for x in self.lists]) if self.lists else np.zeros(0)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.term >> U64(44)).astype(np.int64)] = True

    def terms_of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and which terms."""
        at = np.flatnonzero(self.seen[(h >> U64(44)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.term, h[at]), len(self.term) - 1)
        ok = self.term[k] == h[at]
        return at[ok], k[ok]

    def retrieve(self, terms: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All items whose score for these distinct terms is at or above the threshold: block-max WAND."""
        lists = [self.lists[k] for k in terms.tolist()]
        bound = self.bound[terms].tolist()
        at = [0] * len(lists)
        doc = [int(x[0][0]) for x in lists]
        slack = threshold - 1e-9
        out = []

        def seek(k: int, target: int) -> None:
            items = lists[k][0]
            at[k] += int(np.searchsorted(items[at[k] :], target))
            doc[k] = int(items[at[k]]) if at[k] < len(items) else _END

        while True:
            order = sorted(range(len(lists)), key=doc.__getitem__)
            total, pivot = 0.0, -1
            for n, k in enumerate(order):
                if doc[k] == _END:
                    break
                total += bound[k]
                if total >= slack:
                    pivot = n
                    break
            if pivot < 0:
                return out
            target = doc[order[pivot]]
            while pivot + 1 < len(order) and doc[order[pivot + 1]] == target:
                pivot += 1
            # the blocks that hold the pivot, without moving into them
            most, step = 0.0, _END
            for k in order[: pivot + 1]:
                items, _, blocks = lists[k]
                p = at[k] if doc[k] >= target else at[k] + int(np.searchsorted(items[at[k] :], target))
                if p < len(items):
                    most += float(blocks[p // POSTINGS])
                    edge = (p // POSTINGS + 1) * POSTINGS
                    step = min(step, int(items[edge - 1]) + 1 if edge <= len(items) else _END)
            if most >= slack:
                if doc[order[0]] == target:
                    score = sum(float(lists[k][1][at[k]]) for k in order[: pivot + 1])
                    if score >= slack:
                        out.append((target, score))
                    for k in order[: pivot + 1]:
                        seek(k, target + 1)
                else:
                    for k in order[: pivot + 1]:
                        if doc[k] < target:
                            seek(k, target)
            else:
                if pivot + 1 < len(order):
                    step = min(step, doc[order[pivot + 1]])
                step = max(step, target + 1)
                for k in order[: pivot + 1]:
                    seek(k, step)

    def reachable(self, pair: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """The windows in which the essential terms of one item, and all that the others can add, make the threshold.
        pair: window and essential term; open_: windows whose bounds, over any items, allow it."""
        n = len(self.term)
        pair = pair[open_[pair // n]]
        if not len(pair):
            return pair
        count = (self.head[1:] - self.head[:-1])[pair % n]
        at = C.ranges(self.head[pair % n], count)
        cell = np.repeat(pair // n, count) * np.int64(len(self.ids)) + self.items[at]
        order = np.argsort(cell, kind="stable")
        cell, impact = cell[order], self.impacts[at][order]
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        enough = np.add.reduceat(impact, first) + self.spare >= THRESHOLD - 1e-9
        return np.unique(cell[first][enough] // len(self.ids))

    def matches(self, first: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """Text, item, score and overlaps of question and answer, of each text and item at their best window. h: the words
        of all texts; first: where each text's begin, and the last's end."""
        if not self.ids:
            return
        at, term = self.terms_of(h)
        if not len(at):
            return
        stride = self.window
        doc = np.searchsorted(first, at, "right") - 1
        local = at - first[doc]
        slots = np.maximum(1, -(-np.diff(first) // stride))
        base = np.cumsum(slots) - slots
        # a word lies in the window that begins in its stride, and in the one before
        e = np.flatnonzero(self.essential[term])
        cell = base[doc[e]] + local[e] // stride
        pair = np.unique(np.r_[cell, cell[local[e] >= stride] - 1] * np.int64(len(self.term)) + np.r_[term[e], term[e][local[e] >= stride]])
        total = np.bincount(pair // len(self.term), weights=self.bound[pair % len(self.term)], minlength=int(slots.sum()))
        hot = self.reachable(pair, total + self.spare >= THRESHOLD - 1e-9)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        owner = np.searchsorted(base, hot, "right") - 1
        for c, d in zip(hot.tolist(), owner.tolist()):
            a = int(first[d]) + (c - int(base[d])) * stride
            b = min(int(first[d + 1]), a + 2 * stride)
            lo, hi = np.searchsorted(at, (a, b))
            for item, score in self.retrieve(np.unique(term[lo:hi])):
                grams = [np.unique(C.grams(h[a:b], n)) if b - a >= n else np.zeros(0, U64) for n in range(1, NGRAM + 1)]
                share = []
                for part in (self.question[item], self.answer[item]):
                    share.append(max(float(np.isin(part, g).mean()) for g in grams) if len(part) else 1.0)
                if share[0] >= QUESTION and share[1] >= ANSWER:
                    best[d, item] = max(best.get((d, item), (0.0, 0.0, 0.0)), (score, *share))
        for (d, item), (score, q, a) in sorted(best.items()):
            yield d, self.ids[item], score, q, a


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for r in benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        held.append((r.item_id, r.text))
        size += len(r.text)
        if len(held) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def indexes(benchmark: DataFrame) -> Iterator[list[Index]]:
    """For each block of items, of bounded size, its indexes (one a length of windows), by the statistics of all items."""
    whole = Statistics()
    for block in _blocks(benchmark):
        whole.add([text for _, text in block])
    for block in _blocks(benchmark):
        by_stride: dict[int, list[tuple[int, str]]] = {}
        for i, text in block:
            by_stride.setdefault(stride(max(1, len(_words(text)))), []).append((i, text))
        yield [Index.of(items, whole) for _, items in sorted(by_stride.items())]


def _over(group: list[Index], emit: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = C.text_bytes(batch.column(batch.schema.get_field_index("text")))
            for i, j in C.text_runs(off):
                t = tokens(data[off[i] : off[j]], off[i : j + 1] - off[i])
                words = t.words()
                yield from emit(batch.slice(i, j - i), sorted(x for index in group for x in index.matches(t.first, words)))

    return run


RESULT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score and overlaps of each document that holds a test item."""

    def emit(batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        if found:
            d, item, score, q, a = zip(*found)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), pa.array(item, pa.int64()), pa.array(score), pa.array(q), pa.array(a)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    out = None
    for group in indexes(benchmark):
        part = C.map_batches(rows, _over(group, emit), RESULT)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], RESULT) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no test item."""

    def emit(batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        keep = np.ones(len(batch), bool)
        keep[[x[0] for x in found]] = False
        yield batch.filter(pa.array(keep))

    for group in indexes(benchmark):
        docs = C.map_batches(docs, _over(group, emit), docs.schema)
    return docs
