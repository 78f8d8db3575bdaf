"""Phrase collocations: n-gram counts from word-id suffix arrays, merged by key, scored by their weakest cut.

Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into words at blanks and tabs.
Each shard of some megabytes of text numbers its words and sorts its suffixes by numpy prefix doubling (depths 1, 2, 4; a
suffix ends with its piece). The LCP intervals of depth n are the shard's n-grams with their counts.

Two passes merge them exactly without shipping every n-gram as text:
1. Keys of 64 bits with counts are packed by bucket of the key, after tasks have merged those of their shards. What reaches
   the threshold sets a bit of a fixed table of 2**BITS bits (32 MB, whatever the input), which the second pass gets.
2. Shards emit those n-grams as text whose bit is set, and Spark sums them by language and phrase. Sums decide; keys that
   share a bit only cost rows. With far more frequent n-grams than bits the second pass ships more, with equal results.

Parts of a frequent phrase are frequent, so cuts and enclosing phrases are joins of the frequent table with itself.

Defined results: null texts are empty, null languages `und`; repeated rows count each; extra columns have no influence;
an empty table gives an empty result. A text of any length is cut into windows that overlap by three words, so memory
follows the window (or a longer word), not the text. Ties follow the stated order; scores are exact whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _common as C

LONGEST = 4
SHARD_BYTES = 2 << 20
#: Entries that a task holds before it merges them, and ships them if they are still more than half as many.
HELD = 1 << 21
BITS = 28
#: Rows of a batch of phrases.
ROWS = 1 << 16
#: Buckets of the keys for each shuffle partition.
FINE = 8
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


class Words(NamedTuple):
    """Words of some texts: their bytes' places, the text each is of, and how many words its piece has from it on."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    rest: np.ndarray


def words(data: np.ndarray, off: np.ndarray) -> Words:
    kind = _KIND[data]
    ink = kind == 0
    n = len(data)
    border = np.zeros(n + 1, bool)
    border[off] = True
    first = ink & np.r_[True, ~ink[:-1]] if n else ink
    first |= ink & border[:n]
    last = ink & (np.r_[~ink[1:], True] | border[1:]) if n else ink
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(off, start, "right") - 1
    if not len(start):
        return Words(start, end, text, start)
    piece = np.cumsum(kind == 2, dtype=np.int64)[start]
    new = np.r_[True, (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])]
    heads = np.r_[np.flatnonzero(new), len(start)]
    rest = np.minimum(heads[np.cumsum(new)] - np.arange(len(start)), LONGEST)
    return Words(start, end, text, rest)


def windows(data: np.ndarray, off: np.ndarray, size: int = SHARD_BYTES) -> Iterator[tuple[np.ndarray, Words, int, int]]:
    """Lower-cased bytes, their words (text numbers as in off) and how many of these are counted here. A window of a longer
    text counts all words but its last three, with which the next one begins."""
    for i, j in C.text_runs(off, size):
        part, base = LOWER[data[off[i] : off[j]]], off[i]
        if j - i > 1 or len(part) <= size:
            w = words(part, off[i : j + 1] - base)
            yield part, w._replace(text=w.text + i), len(w.start), i
            continue
        at, most = 0, size
        while at < len(part):
            to = min(at + most, len(part))
            if to < len(part):
                gap = np.flatnonzero(_KIND[part[at:to]])
                to = at + int(gap[-1]) if len(gap) else at
            w = words(part[at:to], np.array([0, to - at]))
            done = to == len(part)
            if not done and len(w.start) <= LONGEST:
                most *= 2
                continue
            owned = len(w.start) if done else len(w.start) - LONGEST + 1
            yield part[at:to], w._replace(text=w.text + i), owned, i
            if done:
                break
            at, most = at + int(w.start[owned]), size


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def numbered(data: np.ndarray, w: Words, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of each word in its language, and its number among the shard's words. Numbers go by 128 bits."""
    h = C.mix(C.word_hashes(data, w.start, w.end) + seed)
    _, rep, number = np.unique(h, return_index=True, return_inverse=True)
    other = C.word_hashes(data, w.start, w.end, C.T2) ^ seed
    if not np.array_equal(other[rep][number], other):
        number = np.unique(np.stack([h, other], 1), axis=0, return_inverse=True)[1].ravel()
    return h, number


def _then(rank: np.ndarray, rest: np.ndarray, k: int) -> np.ndarray:
    """Of each word the rank of that k words on, 0 beyond its piece."""
    out = np.zeros(len(rank), np.int64)
    out[:-k] = np.where(rest[:-k] > k, rank[k:], 0)
    return out


def ngrams(number: np.ndarray, rest: np.ndarray, owned: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For n = 1 to 4 the LCP intervals of that depth: a place of each n-gram and how often it begins at an owned word."""
    if not len(number):
        return
    one = number.astype(np.int64) + 1
    pair = one * (one.max() + 1) + _then(one, rest, 1)
    two = np.unique(pair, return_inverse=True)[1].ravel() + 1
    four = two * (two.max() + 1) + _then(two, rest, 2)
    suffix = np.argsort(four, kind="stable")
    third = _then(one, rest, 2)
    counted = (suffix < owned).astype(np.int64)
    changed = lambda x: x[suffix[1:]] != x[suffix[:-1]]
    by_two = changed(two)
    for n, edge in ((1, changed(one)), (2, by_two), (3, by_two | changed(third)), (4, changed(four))):
        head = np.r_[0, np.flatnonzero(edge) + 1]
        place, count = suffix[head], np.add.reduceat(counted, head)
        real = (rest[place] >= n) & (count > 0)
        yield n, place[real], count[real]


def keys(h: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    out = np.full(len(place), n, np.uint64)
    for i in range(n):
        out = C.mix(out * C.BASE + h[place + i])
    return out


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Words, int, np.ndarray, np.ndarray, list[str]]]:
    langs = ["und" if x is None else x for x in batch.column(0).to_pylist()]
    seeds = np.array([_seed(x) for x in langs], np.uint64)
    data, off = C.text_bytes(batch.column(1))
    for part, w, owned, _ in windows(data, off):
        if len(w.start):
            h, number = numbered(part, w, seeds[w.text])
            yield part, w, owned, h, number, langs


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
    order = np.argsort(k)
    k, c = k[order], c[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(c, head) if len(k) else c


def _pack(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            held, size = [], 0

            def shipped(k: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
                for b, at in C.split(C.bucket_of(k, buckets)):
                    yield b, 0, C.pack([c[at]], [k[at]])

            for batch in batches:
                for _, w, owned, h, number, _ in _shards(batch):
                    for n, place, count in ngrams(number, w.rest, owned):
                        held.append((keys(h, place, n), count))
                        size += len(place)
                    if size >= HELD:
                        held = [_summed(held)]
                        size = len(held[0][0])
                        if size >= HELD // 2:
                            yield from shipped(*held.pop())
                            size = 0
            if held:
                yield from shipped(*_summed(held))

        yield from C.packed_batches(rows())

    return run


def _frequent(buckets: int, least: int, bits: int):
    """The bits of a bucket's frequent keys, packed from the byte of its first key on."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, HELD
        for _, blob in rows:
            c, k = C.unpack(blob)
            held.append((k, c))
            size += len(k)
            if size >= most:
                held = [_summed(held)]
                size = len(held[0][0])
                most = max(HELD, 2 * size)
        k, c = _summed(held)
        cells = (k[c >= least] >> np.uint64(64 - bits)).astype(np.int64)
        if len(cells):
            low, high = int(cells.min()) // 8, int(cells.max()) // 8 + 1
            flags = np.zeros((high - low) * 8, np.uint8)
            flags[cells - low * 8] = 1
            yield pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), pa.array([C.pack([np.packbits(flags)])], pa.binary())], names=["low", "blob"])

    return fn


def _phrases(table, bits: int):
    """lang, number of words, phrase and count of the n-grams whose bit is set; of no words: all words of a language."""

    def made(langs: list[str], n: list[int], said: list[str], f: list[int]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((langs, n, said, f), kinds)], names=["lang", "words", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, w, owned, h, number, langs in _shards(batch):
                total = np.bincount(w.text[:owned], minlength=len(langs))
                some = np.flatnonzero(total)
                yield made([langs[t] for t in some.tolist()], [0] * len(some), [""] * len(some), total[some].tolist())
                said: dict[int, str] = {}

                def word(i: int, data=data, w=w, number=number, said=said) -> str:
                    x = said.get(number[i])
                    if x is None:
                        x = said[number[i]] = data[w.start[i] : w.end[i]].tobytes().decode()
                    return x

                for n, place, count in ngrams(number, w.rest, owned):
                    cell = (keys(h, place, n) >> np.uint64(64 - bits)).astype(np.int64)
                    hit = np.flatnonzero(table.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1)
                    for i in range(0, len(hit), ROWS):
                        at = place[hit[i : i + ROWS]]
                        phrases = [" ".join([word(x + j) for j in range(n)]) for x in at.tolist()]
                        yield made([langs[t] for t in w.text[at].tolist()], [n] * len(at), phrases, count[hit[i : i + ROWS]].tolist())

    return run


def frequent(docs: DataFrame, least: int = 30, bits: int = BITS) -> DataFrame:
    """lang, words, phrase and count f of all phrases of 1 to 4 words with f >= least, and of each language a row of no
    words whose f is the number of its words."""
    spark = docs.sparkSession
    texts = docs.select(docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    buckets = FINE * C.partitions(spark)
    packed = C.map_batches(texts, _pack(buckets), C.PACKED_SQL)
    flags = C.stored(C.by_bucket(packed, _frequent(buckets, least, bits), "low long, blob binary"), "frequent-bits")
    table = np.zeros(1 << (bits - 3), np.uint8)
    for r in flags.toLocalIterator():
        piece = C.unpack(bytes(r.blob))[0]
        table[r.low : r.low + len(piece)] |= piece
    found = C.map_batches(texts, _phrases(spark.sparkContext.broadcast(table), bits), "lang string, words int, phrase string, f long")
    counts = found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return C.stored(counts.where((F.col("f") >= least) | (F.col("words") == 0)), "phrases")


def mine(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, share: int = 80) -> DataFrame:
    """The first `top` phrases of each language by the score of their weakest cut, without those that a longer phrase
    holds in at least `share` percent of their occurrences."""
    counts = frequent(docs, least)
    word = F.split("phrase", " ")
    some = counts.where("words > 0").select("lang", "phrase", "f")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), word.alias("w"))
    cuts = candidates.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "w"
    ).select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("rest"))
    left = some.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = some.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: f"CAST({c} AS DECIMAL(38, 0))"
    score = F.expr(f"{wide(scale)} * {wide('a')} div ({wide('l')} + {wide('r')})")
    weakest = (
        cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    longer = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    held = F.expr(f"100 * {wide('longer')} >= {share} * {wide('a')}")
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.coalesce(~held, F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    best = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
