"""Exact counts of phrases that are frequent enough, for runs of words of any number of texts.

A batch counts its own phrases (as numbers of its vocabulary) and ships the distinct ones packed, by bucket of a hash of their
key: a frequent phrase costs a record a batch. A bucket adds up the uses by hash and drops what stays under the least
number, whatever its texts, before it looks at any text: equal hashes of different keys only let more through. What is
left is counted by its text, so the counts are exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import batches

U64 = np.uint64
TOKEN = re.compile("[a-z][a-z-]{2,}")
BASE = U64(0x9E3779B97F4A7C15)
#: Characters of texts that are counted together; buckets for each shuffle partition, and at least.
RUN, SPLIT, LEAST = 4 << 20, 6, 512
_ZSTD = pa.Codec("zstd", compression_level=1)
_MASK = (1 << 64) - 1


def word_hash(word: str) -> int:
    h = 1469598103934665603
    for c in word.encode():
        h = (h ^ c) * 1099511628211 & _MASK
    return h


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Words:
    """What a task knows of words: `parts` gives the words of a word's key; `known` is what means something by itself;
    `whole` is a phrase alone. It keeps the words of a few batches, not of all."""

    MOST = 150_000

    def __init__(self, parts: Callable[[str], list[str]], known: Callable[[str], bool], whole: Callable[[str], bool]) -> None:
        self.parts, self.known, self.whole, self.seen = parts, known, whole, {}

    def facts(self, word: str) -> tuple[int, int, int]:
        h, key = 0, self.parts(word)
        for x in key:
            h = h * int(BASE) + word_hash(x) & _MASK
        return h, pow(int(BASE), len(key), 1 << 64), (known := bool(self.known(word))) + 2 * (known and len(word) > 4) + 4 * bool(self.whole(word))

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.seen) > self.MOST:
            self.seen.clear()
        seen = self.seen
        for w in words:
            if w not in seen:
                seen[w] = self.facts(w)
        return np.array([seen[w] for w in words], U64).reshape(-1, 3).T


class Vocabulary:
    """The words of a batch: hashes of their keys, and which mean something by themselves, are long, or phrases alone."""

    def __init__(self, words: pa.Array, known: Words) -> None:
        self.words = words
        self.hash, self.shift, flags = known.of(words.to_pylist())
        self.known, self.long, self.whole = ((flags & U64(k)) > 0 for k in (1, 2, 4))

    def key(self, columns: list[np.ndarray]) -> np.ndarray:
        h = self.hash[columns[0]]
        for c in columns[1:]:
            h = h * self.shift[c] + self.hash[c]
        return mix(h)

    def tells(self, columns: list[np.ndarray]) -> np.ndarray:
        """Two words at least mean something by themselves, and one of these is long."""
        return (sum(self.known[c].astype(np.int8) for c in columns) >= 2) & np.logical_or.reduce([self.long[c] for c in columns])

    def text(self, columns: list[np.ndarray]) -> pa.Array:
        return pc.binary_join_element_wise(*[self.words.take(pa.array(c)) for c in columns], pa.scalar(" ", pa.large_string())) if len(columns) > 1 else self.words.take(pa.array(columns[0]))


def runs(codes: np.ndarray, size: np.ndarray, words: int, n: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """For one word, two, ... n: the columns of the distinct runs of so many words within a text, and their uses."""
    left = np.repeat(np.cumsum(size), size) - np.arange(len(codes))  # words to the text's end, this one included
    ids, columns = codes.astype(np.int64), [np.arange(words)]
    yield columns, np.bincount(codes, minlength=words)
    for k in range(2, n + 1):
        at = np.flatnonzero(left[: len(ids)] >= k)
        pair, inverse, times = np.unique(ids[at] * words + codes[at + k - 1], return_inverse=True, return_counts=True)
        columns = [c[pair // words] for c in columns] + [pair % words]
        yield columns, times
        ids = np.zeros(len(codes), np.int64)
        ids[at] = inverse


def _pack(book: str | None, key: np.ndarray, n: np.ndarray, size: np.ndarray, text: bytes) -> bytes:
    name = b"\x00" if book is None else b"\x01" + book.encode()
    body = b"".join([name, key.tobytes(), n.astype("<u4").tobytes(), size.astype("<u4").tobytes(), text])
    return np.array([len(body), len(name), len(key)], "<u4").tobytes() + _ZSTD.compress(body, asbytes=True)


def _unpack(blob: bytes) -> tuple[str | None, np.ndarray, np.ndarray, pa.Array]:
    total, name, count = np.frombuffer(blob, "<u4", 3).tolist()
    body = _ZSTD.decompress(blob[12:], total, asbytes=True)
    key, n, size = (np.frombuffer(body, "<u4", count, name + 4 * count * i) for i in range(3))
    off = np.zeros(count + 1, np.int64)
    np.cumsum(size, out=off[1:])
    text = pa.Array.from_buffers(pa.large_string(), count, [None, pa.py_buffer(off), pa.py_buffer(body[name + 12 * count :])])
    return (body[1:name].decode() if body[0] else None), key, n.astype(np.int64), text


def _counted(phrases: Callable, parts: Callable, known: Callable, whole: Callable, longest: int, buckets: int):
    def packets(book: str | None, texts: list[str], seen: Words) -> Iterator[tuple[int, bytes]]:
        words = [TOKEN.findall(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(words)), pa.large_string()).dictionary_encode()
        if not len(coded):
            return
        codes, vocabulary = coded.indices.to_numpy(), Vocabulary(coded.dictionary, seen)
        for columns, n in runs(codes, np.array([len(w) for w in words]), len(vocabulary.words), longest):
            ok = phrases(vocabulary, columns)
            columns, n = [c[ok] for c in columns], n[ok]
            if not len(n):
                continue
            h = vocabulary.key(columns)
            bucket = ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            text = vocabulary.text([c[order] for c in columns])
            off = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
            raw, key, n, bucket = memoryview(text.buffers()[2]), h[order].astype("<u4"), n[order], bucket[order]
            size, cut = np.diff(off), np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for i, j in zip(cut[:-1], cut[1:]):
                yield int(bucket[i]), _pack(book, key[i:j], n[i:j], size[i:j], bytes(raw[off[i] : off[j]]))

    def fn(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Words(parts, known, whole)
        for batch in arrow:
            by: dict[str | None, list[str]] = {}
            for book, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(book, []).append(text)
            for book, texts in by.items():
                at = np.cumsum([len(t) for t in texts]) // RUN
                cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True])
                for i, j in zip(cut[:-1], cut[1:]):
                    held = list(packets(book, texts[i:j], seen))
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in held], pa.int32()), pa.array([x for _, x in held], pa.binary())], names=["bucket", "blob"])

    return fn


def _frequent(least: int, alone: bool):
    """Of a bucket's phrases those whose key has `least` uses and, unless alone, other phrases."""

    def told(held: dict[str | None, list[tuple]]) -> Iterator[pa.RecordBatch]:
        for book, packs in held.items():
            key, n = (np.concatenate([p[i] for p in packs]) for i in (0, 1))
            _, place = np.unique(key, return_inverse=True)
            ok = np.bincount(place, n)[place] >= least
            text = pa.chunked_array([p[2] for p in packs]).filter(pa.array(ok))
            sums = pa.table({"key": place[ok], "phrase": text, "n": n[ok]}).group_by(["key", "phrase"]).aggregate([("n", "sum")])
            if not alone:
                _, place, forms = np.unique(sums["key"].to_numpy(), return_inverse=True, return_counts=True)
                sums = sums.filter(pa.array(forms[place] >= 2))
            for part in sums.combine_chunks().to_batches(max_chunksize=100_000):
                yield pa.RecordBatch.from_arrays([pa.array([book] * len(part), pa.string()), part.column("phrase").cast(pa.string()), part.column("n_sum").cast(pa.int64())], names=["book", "phrase", "n"])

    def fn(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[tuple]] = {}
        now = None
        for batch in arrow:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now:
                    yield from told(held)
                    held, now = {}, bucket
                book, *rest = _unpack(blob.as_py())
                held.setdefault(book, []).append(rest)
        yield from told(held)

    return fn


def frequent(rows: DataFrame, book: Column, text: Column, phrases: Callable, parts: Callable, known: Callable, whole: Callable, longest: int, least: int, alone: bool) -> DataFrame:
    """book (string), phrase and its uses n, of runs of up to `longest` words for which phrases(vocabulary, columns) holds, where
    the runs with one key have `least` uses together; unless `alone`, of keys with two different runs at least."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = _counted(phrases, parts, known, whole, longest, max(LEAST, SPLIT * n))
    packed = batches.mapped(rows.select(book.cast("string").alias("book"), F.lower(F.coalesce(text, F.lit(""))).alias("text")), counted, "bucket int, blob binary")
    return batches.mapped(packed.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket"), _frequent(least, alone), "book string, phrase string, n long")
