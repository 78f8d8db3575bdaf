"""Substring deduplication by seed and extend: words covered by a long run of words that an earlier document has too.

Method: winnowed anchors of a few words (the seeds) bring documents together; see repeats.py. From each seed the match
is extended word by word to both sides, for all occurrences of the seed at once: occurrences stay in one class while
they agree, so no pairs are formed. A window is a maximal repeat's part if its left and its right extension fall in
classes that an earlier document shares; maximal runs at or over the threshold are removed.

Words are runs of anything but blank and \\t..\\r. Defined results: null text has no words; null doc_id is larger than
all others; documents shorter than the window lose nothing; equal doc_ids don't cover each other; repeated rows each get
the same result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _common as C
from .repeats import Plan, removed

U64 = np.uint64
WINDOW = 50


def find(window: int, k: int):
    def fn(ids: np.ndarray, count: np.ndarray, lead: np.ndarray, size: np.ndarray, text: np.ndarray, key: np.ndarray) -> np.ndarray:
        start, end, first = C.words(text, np.r_[0, np.cumsum(size)])
        word = C.word_hashes(text, start, end, C.T2)
        seed = first[:-1] + lead
        # classes of the extensions: at n words to either side of the seed
        deep = window - k
        left, right = np.empty((len(ids), deep + 1), U64), np.empty((len(ids), deep + 1), U64)
        left[:, 0], right[:, 0] = key, C.mix(key)
        for n in range(1, deep + 1):
            at = seed - n
            ok = at >= first[:-1]
            left[:, n] = left[:, n - 1]
            left[ok, n] = C.mix(left[ok, n - 1] * C.BASE + word[at[ok]])
            at = seed + k + n - 1
            ok = at < first[1:]
            right[:, n] = right[:, n - 1]
            right[ok, n] = C.mix(right[ok, n - 1] * C.BASE + word[at[ok]])
        row = np.repeat(np.arange(len(ids)), count)
        back = lead[row] - C.ranges(np.zeros(len(ids), np.int64), count)  # words of the window before the seed
        a, b = left[row, back], right[row, deep - back]
        doc = ids[row]
        order = np.lexsort((b, a))
        new = np.r_[True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])] if len(order) else np.zeros(0, bool)
        klass = np.cumsum(new) - 1
        least = np.full(klass[-1] + 1 if len(klass) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, klass, doc[order])
        over = np.zeros(len(row), bool)
        over[order] = doc[order] > least[klass]
        return over

    return fn


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _result(keep: bool):
    def fn(ids: pa.Array, data: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, o: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
        size = np.diff(o)
        total = np.r_[0, np.cumsum(mask)]
        gone = total[o[1:]] - total[o[:-1]]
        s, e = start[~mask], end[~mask]
        # the kept words, each with a blank behind
        n = e - s + 1
        out = np.full(int(n.sum()), 32, np.uint8)
        place = np.cumsum(n) - n
        out[C.ranges(place, n - 1)] = data[C.ranges(s, n - 1)]
        edge = np.r_[place, len(out)][np.r_[0, np.cumsum(size - gone)]]
        parts = [out[i : max(i, j - 1)].tobytes() for i, j in zip(edge[:-1], edge[1:])]
        cols = [ids, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string())]
        if keep:
            cols.append(pa.array(parts, pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: len(cols)])

    return fn


def dedup(docs: DataFrame, window: int = WINDOW, keep: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with keep, the kept words of each of docs (doc_id, text)."""
    k = max(1, min(8, window // 3))
    return removed(docs, Plan(window, k, True), find(window, k), _result(keep), RESULT + ", kept string" * keep)
