"""Suffix-array deduplication: bytes covered by a long string that an earlier document has too are removed.

Method: deep-shallow sorting. The suffixes to order are the window starts that winnowing leaves open (see repeats.py):
multikey quicksort on eight bytes at a time puts them in order to a shallow depth, and blind tries order what is still
equal there. Suffixes are compared to the depth of the window; neighbours that agree so far are one repeated string.

Defined results: null text is empty; null doc_id is larger than all others and is returned as null; documents shorter
than the window lose nothing; rows with equal doc_id don't cover each other; repeated rows each get the same result;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _common as C
from .repeats import Plan, removed

WINDOW = 50
#: Bytes to which suffixes are sorted by words of eight, before blind tries take over.
SHALLOW = 40


class BlindTrie:
    """Orders strings of one length. Inner nodes keep only the depth where their children part; the bytes between are
    skipped on the way down and checked against one leaf at the end."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings, self.root = strings, None

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [None, {}, [i]]
            return
        node = self.root
        while node[0] is not None:  # blind: by the branching bytes alone
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        t = self.strings[node[2][0]]
        if s == t:
            node[2].append(i)
            return
        depth = next(d for d, (a, b) in enumerate(zip(s, t)) if a != b)
        parent, node = None, self.root
        while node[0] is not None and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        leaf = [None, {}, [i]]
        if node[0] == depth:
            node[1][s[depth]] = leaf
            return
        fork = [depth, {t[depth]: node, s[depth]: leaf}, []]
        if parent is None:
            self.root = fork
        else:
            parent[1][s[parent[0]]] = fork

    def groups(self) -> list[list[int]]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                out.append(node[2])
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def _words_at(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n <= 8 bytes of the text at each place, as big-endian numbers."""
    out = np.zeros(len(at), np.uint64)
    for i in range(n):
        out = (out << np.uint64(8)) | text[at + i]
    return out


def deep_shallow(text: np.ndarray, at: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes `at` in order of their first `depth` bytes, and the class of each in that order (equal: same class)."""
    order = np.arange(len(at))
    klass = np.zeros(len(at), np.int64)
    for d in range(0, min(shallow, depth), 8):
        # multikey: the next eight bytes split every group that still has more than one suffix
        size = np.bincount(klass)
        open_ = np.flatnonzero(size[klass] > 1)
        if not len(open_):
            break
        key = _words_at(text, at[order[open_]] + d, min(8, depth - d))
        sub = np.lexsort((key, klass[open_]))
        order[open_] = order[open_][sub]
        key, k = key[sub], klass[open_]
        part = np.zeros(len(at), bool)
        part[open_[1:]] = (key[1:] != key[:-1]) & (k[1:] == k[:-1])
        klass = np.cumsum(np.r_[False, klass[1:] != klass[:-1]] | part)
    if shallow < depth and len(at):
        new = np.r_[True, klass[1:] != klass[:-1]]
        head = np.flatnonzero(new)
        first = at[order[head]][klass - klass[0]]
        differs = np.zeros(len(at), bool)
        for d in range(shallow, depth):
            differs |= text[at[order] + d] != text[first + d]
        split = np.zeros(len(at), bool)
        for g in np.unique(klass[differs]):
            i, j = np.searchsorted(klass, g, "left"), np.searchsorted(klass, g, "right")
            tails = [text[p + shallow : p + depth].tobytes() for p in at[order[i:j]]]
            trie = BlindTrie(tails)
            for n in range(j - i):
                trie.add(n)
            groups = trie.groups()
            order[i:j] = order[i:j][np.concatenate(groups)]
            split[i + np.cumsum([len(x) for x in groups])[:-1]] = True
        klass = np.cumsum(np.r_[False, new[1:]] | split)
    return order, klass


def find(window: int):
    def fn(ids: np.ndarray, count: np.ndarray, lead: np.ndarray, size: np.ndarray, text: np.ndarray, key: np.ndarray) -> np.ndarray:
        start = np.cumsum(size) - size
        at = C.ranges(start, count)
        doc = np.repeat(ids, count)
        order, klass = deep_shallow(text, at, window)
        least = np.full(klass[-1] + 1 if len(klass) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, klass, doc[order])
        over = np.zeros(len(at), bool)
        over[order] = doc[order] > least[klass]
        return over

    return fn


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: What may stand behind: nothing, the remaining bytes, or those as text, without the bytes of characters that were cut.
KEPT = {"": "", "bytes": ", kept binary", "text": ", kept string"}


def _result(keep: str):
    def fn(ids: pa.Array, data: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, o: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
        size = np.diff(off)
        total = np.r_[0, np.cumsum(mask)]
        gone = total[off[1:]] - total[off[:-1]]
        begins = mask.copy()
        begins[1:] &= ~mask[:-1]
        inner = off[:-1][size > 0]
        begins[inner] = mask[inner]
        runs = np.r_[0, np.cumsum(begins)]
        kept, place = data[~mask], np.r_[0, np.cumsum(size - gone)]
        parts = [kept[i:j].tobytes() for i, j in zip(place[:-1], place[1:])]
        cols = [ids, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs[off[1:]] - runs[off[:-1]], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string())]
        if keep:
            cols.append(pa.array(parts, pa.binary()) if keep == "bytes" else pa.array([x.decode("utf-8", "ignore") for x in parts], pa.string()))
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(cols)])

    return fn


def dedup(docs: DataFrame, window: int = WINDOW, keep: str = "bytes", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and what remains (see KEPT) of each of docs (doc_id, text), with
    the columns `carry` of docs behind, as carried_0, carried_1, ..."""
    k = max(1, min(16, window // 3))
    return removed(docs, Plan(window, k, False), find(window), _result(keep), RESULT + KEPT[keep], carry)
