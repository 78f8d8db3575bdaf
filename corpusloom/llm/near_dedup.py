"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles, banded and verified.

1. A shingle is five words (a shorter text is one shingle). It weighs its count in the text times an inverse document
   frequency, taken from the share of documents that hold it: 1 in all of them, 1 + SPAN where no more than FREQUENT do.
   The shingles above that share are counted exactly, over all documents; they are at most a text's mean number of
   shingles over FREQUENT, whatever the corpus, and that table is all that tasks get. SPAN is small, so that a group's
   own size moves its similarity little.
2. ICWS (Ioffe, 2010) draws consistent samples: two texts agree in a sample with the probability of their weighted
   Jaccard similarity. Every occurrence of a shingle is drawn, so a count is so many elements. Texts of a weight up to
   SMALL draw each element for each of BINS samples; from 0.8 of that weight on (the least that a partner can have) each
   element is drawn once, in one of BINS bins by its hash, and empty bins borrow the next full one. Between the two a
   text has both signatures, so that all pairs at the threshold have one in common.
3. Bins make bands of ROWS. Texts that share a band meet; there, all others are compared by sampled similarity with a
   leader, those close to it leave, for LEADERS turns. The first leaders are central texts (most alike to three others,
   judged by another half of the bins in other bands), so that an original leads its copies and doesn't leave with one
   of them; later ones are the least documents.
4. Candidate pairs are verified by the exact weighted Jaccard similarity of their whole shingle sets. A leader's text is
   sent once to each task that needs it.
5. The classes that these links make go back to the bands, and there all pairs of texts of different classes with a
   sampled similarity of MAYBE are verified, too: a link is found whoever led. In a group over PREFIX_FROM texts the pairs
   come from a prefix filter on the samples, which finds the same pairs: two texts that agree in so many samples share one
   of the rarest of each.
6. Links and equal texts make classes (connected components, by label spreading with pointer jumping on tables in the
   shared folder). A row's class_id is the least doc_id of its class.

What can be lost is a pair at the threshold that shares no band (0.488^21, or 3e-7, at a similarity of 0.8) or whose 63
samples agree in under MAYBE (four standard deviations below 0.8).

Defined results: a null text is empty; texts without words are alike only if equal; a null doc_id counts as larger than
all others and class_id is null only where the whole class has null ids; repeated rows share a class and each get a row;
a text of any length is one record; an empty table gives an empty result; other columns of any name are ignored (dedup()
keeps them). Texts are told apart by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

U64 = np.uint64
SHINGLE = 5
THRESHOLD = 0.8
#: Share of documents beyond which a shingle's frequency counts, and how much more than a shingle in all documents a rare one weighs.
FREQUENT, SPAN = 1 / 512, 0.25
#: Rows of hashed counts that tell which shingles can be frequent.
COUNT_BITS = 21
BINS, ROWS = 63, 3
BANDS = BINS // ROWS
#: Weight of a text up to which every sample is drawn from all its elements.
SMALL = 120.0
#: Sampled similarity from which a pair is verified, and from which a text leaves with its leader.
MAYBE, CLOSE = 0.6, 0.9
#: Turns of a group in the first look, and those of them whose leader is its central text.
LEADERS, CENTRAL_TURNS = 4, 2
#: Texts of a group from which its pairs come from a prefix filter.
PREFIX_FROM = 256
#: The bins by which a text's place in its group is judged, in four ways.
HALVES = np.array([[(b + way) % 4 < 2 for b in range(BINS)] for way in range(4)])
NO_ID = np.iinfo(np.int64).max


def shingles(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle of each text, ordered by text."""
    start, end, first = C.words(data, off)
    n = np.diff(first)
    h = C.word_hashes(data, start, end)
    doc = np.repeat(np.arange(len(n)), n)
    full = np.zeros(0, np.int64)
    out = np.zeros(0, U64)
    if len(h) >= k:
        g = C.mix(C.grams(h, k))
        at = np.flatnonzero(doc[: len(g)] == doc[k - 1 :])
        full, out = doc[at], g[at]
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        full = np.r_[full, few]
        out = np.r_[out, C.mix(C.span_hash(C.prefix(h), first[few], first[few + 1]) + U64(k))]
    # distinct within a text: 20 bits of the run's text number in front of the hash
    order = np.lexsort((out, full))
    full, out = full[order], out[order]
    new = np.flatnonzero(np.r_[True, (out[1:] != out[:-1]) | (full[1:] != full[:-1])]) if len(out) else np.zeros(0, np.int64)
    return full[new], out[new], np.diff(np.r_[new, len(out)])


def _row(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - COUNT_BITS)).astype(np.int64)


def _row_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by hashed row of their shingles: no less than any shingle's documents."""
    count, held = np.zeros(1 << COUNT_BITS, np.int32), []
    for batch in batches:
        data, off = C.text_bytes(batch.column(2))
        for i, j in C.text_runs(off):
            held.append(_row(shingles(data[off[i] : off[j]], off[i : j + 1] - off[i])[1]))
            if len(held) >= 32:
                count += np.bincount(np.concatenate(held), minlength=len(count)).astype(np.int32)
                held = []
    if held:
        count += np.bincount(np.concatenate(held), minlength=len(count)).astype(np.int32)
    if count.any():  # parts of the table, so that many tasks add up
        part = len(count) // 64
        yield C.packed_batch([(b, 0, C.pack([count[b * part : (b + 1) * part]])) for b in range(64)])


def _full_rows(least: int):
    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        total = sum(C.unpack(b)[0].astype(np.int64) for _, b in rows)
        at = np.flatnonzero(total >= least)
        if len(at):
            yield C.packed_batch([(bucket, 0, C.pack([(at + bucket * len(total)).astype(np.int32)]))])

    return fn


def _shingle_counts(full: np.ndarray):
    """Documents of each shingle that falls in one of the full rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def combined() -> list:
            h, n = (np.concatenate(x) for x in zip(*held))
            u, back = np.unique(h, return_inverse=True)
            return [(u, np.bincount(back, weights=n).astype(np.int64))]

        for batch in batches:
            data, off = C.text_bytes(batch.column(2))
            for i, j in C.text_runs(off):
                _, h, _ = shingles(data[off[i] : off[j]], off[i : j + 1] - off[i])
                h = h[full[_row(h)]]
                if len(h):
                    held.append((h, np.ones(len(h), np.int64)))
                if len(held) >= 32:
                    held = combined()
        if held:
            ((h, n),) = combined()
            yield from C.packed_batches((b, 0, C.pack([n[at]], [h[at]])) for b, at in C.split(C.bucket_of(h * C.BASE, 64)))

    return run


def _frequent(least: int):
    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        n, h = (np.concatenate(x) for x in zip(*(C.unpack(b) for _, b in rows)))
        u, back = np.unique(h, return_inverse=True)
        n = np.bincount(back, weights=n).astype(np.int64)
        if (n >= least).any():
            yield C.packed_batch([(bucket, 0, C.pack([n[n >= least]], [u[n >= least]]))])

    return fn


class Idf:
    """Inverse document frequencies: of the frequent shingles (sorted hashes and their documents), and of all others."""

    def __init__(self, h: np.ndarray, count: np.ndarray, docs: int) -> None:
        order = np.argsort(h)
        self.h = h[order]
        share = np.minimum(1.0, count[order] / max(1, docs))
        self.weight = 1 + SPAN * np.minimum(1.0, np.log(share) / np.log(FREQUENT)) if len(h) else np.zeros(0)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.h >> U64(48)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), 1 + SPAN)
        at = np.flatnonzero(self.seen[(h >> U64(48)).astype(np.int64)]) if len(self.h) else np.zeros(0, np.int64)
        if len(at):
            k = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
            hit = self.h[k] == h[at]
            out[at[hit]] = self.weight[k[hit]]
        return out


def idf_of(rows: DataFrame, docs: int) -> Idf:
    """Of `docs` documents (doc_id, tid, text), all of which are counted. What comes to the driver is bounded: rows and
    shingles whose documents are no fewer than FREQUENT of all."""
    least = max(2, int(np.ceil(FREQUENT * docs)))
    full = np.zeros(1 << COUNT_BITS, bool)
    for r in C.by_bucket(C.map_batches(rows, _row_counts, C.PACKED_SQL), _full_rows(least), C.PACKED_SQL).toLocalIterator():
        full[C.unpack(bytes(r.blob))[0]] = True
    found = [(np.zeros(0, np.int64), np.zeros(0, U64))]
    if full.any():
        found += [tuple(C.unpack(bytes(r.blob))) for r in C.by_bucket(C.map_batches(rows, _shingle_counts(full), C.PACKED_SQL), _frequent(least), C.PACKED_SQL).toLocalIterator()]
    n, h = (np.concatenate(x) for x in zip(*found))
    return Idf(h, n, docs)


_U = [C.mix(np.array([i + 11], U64))[0] for i in range(5)]


def _uniform(h: np.ndarray, i: int) -> np.ndarray:
    return ((C.mix(h ^ _U[i]) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def icws(h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sampled value and its key of each shingle: the least value of a bin is the bin's sample."""
    r = -np.log(_uniform(h, 0) * _uniform(h, 1))
    c = -np.log(_uniform(h, 2) * _uniform(h, 3))
    beta = _uniform(h, 4)
    t = np.floor(np.log(weight) / r + beta)
    return np.log(c) - r * (t - beta) - r, C.mix(h ^ (t.astype(np.int64).view(U64) * C.BASE))


def _elements(doc: np.ndarray, h: np.ndarray, tf: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and weight of each occurrence: the second, third, ... of a shingle is an element of its own."""
    if not len(tf) or tf.max() == 1:
        return doc, h, weight
    nth = C.ranges(np.zeros(len(tf), np.int64), tf)
    again = np.repeat(h, tf)
    again[nth > 0] = C.mix(again[nth > 0] ^ C.mix(nth[nth > 0].astype(U64)))
    return np.repeat(doc, tf), again, np.repeat(weight, tf)


def binned(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """32 bits for each of BINS bins of each of n texts, from one draw an element; zeros for texts without elements."""
    value, key = icws(h, weight)
    cell = doc * BINS + (h % U64(BINS)).astype(np.int64)
    order = np.lexsort((value, cell))
    cell = cell[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    sig = np.zeros(n * BINS, np.uint32)
    full = np.zeros(n * BINS, bool)
    sig[cell[first]] = (key[order[first]] >> U64(32)).astype(np.uint32) | 1
    full[cell[first]] = True
    sig, full = sig.reshape(n, BINS), full.reshape(n, BINS)
    some = full.any(1)
    out, done = sig.copy(), full.copy()
    for step in range(1, BINS):  # empty bins borrow
        if done[some].all():
            break
        near, ok = np.roll(sig, -step, 1), np.roll(full, -step, 1) & ~done
        out[ok] = near[ok] * np.uint32(2654435761) + np.uint32(step)
        done |= ok
    return out


def independent(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """32 bits for each of BINS samples of each of n texts, each drawn from all elements (ordered by text)."""
    out = np.zeros((n, BINS), np.uint32)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        group = np.cumsum(np.r_[False, doc[1:] != doc[:-1]])
        for b in range(BINS):
            value, key = icws(C.mix(h ^ U64(0xB5297A4D00000000 + b)), weight)
            hit = np.flatnonzero(value == np.minimum.reduceat(value, first)[group])
            out[doc[hit[::-1]], b] = (key[hit[::-1]] >> U64(32)).astype(np.uint32) | 1
    return out


def signatures(doc: np.ndarray, h: np.ndarray, tf: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and samples of each signature of n texts (shingles with their counts and inverse document frequencies, ordered
    by text): a text has one or two, or none if it has no shingles."""
    total = np.bincount(doc, weights=tf * weight, minlength=n)
    out = []
    for draw, mine in ((independent, (total > 0) & (total <= SMALL)), (binned, total >= THRESHOLD * SMALL)):
        which = np.flatnonzero(mine)
        if len(which):
            at = mine[doc]
            place = np.cumsum(mine) - 1
            out.append((which, draw(*_elements(place[doc[at]], h[at], tf[at], weight[at]), len(which))))
    if not out:
        return np.zeros(0, np.int64), np.zeros((0, BINS), np.uint32)
    return tuple(np.concatenate(x) for x in zip(*out))


def _band_keys(sig: np.ndarray, bands: np.ndarray) -> np.ndarray:
    s = sig.astype(U64).reshape(len(sig), BANDS, ROWS)[:, bands]
    h = np.zeros(s.shape[:2], U64)
    for i in range(ROWS):
        h = C.mix(h * C.BASE + s[:, :, i] + U64(1))
    return h ^ C.mix(bands.astype(U64) + U64(77))


def _sketches(idf: Idf, buckets: int):
    """Document, text hash and signatures of each text that has shingles, to the text's bucket; equal texts of a batch go once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                tid = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
                order = np.lexsort((ids, tid))
                keep = np.sort(order[np.r_[True, tid[order][1:] != tid[order][:-1]]]) if len(ids) else order
                ids, tid = ids[keep], tid[keep]
                data, off = C.text_bytes(batch.column(2).take(pa.array(keep)))
                for i, j in C.text_runs(off):
                    doc, h, tf = shingles(data[off[i] : off[j]], off[i : j + 1] - off[i])
                    which, sig = signatures(doc, h, tf, idf.of(h), j - i)
                    d, t = ids[i:j][which], tid[i:j][which]
                    for b, at in C.split(C.bucket_of(t, buckets)):
                        yield b, 1, C.pack([], [d[at], t[at], sig[at].ravel()])

        yield from C.packed_batches(rows())

    return run


def _dealt(sig: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each bucket of bands: the rows of sig that have a band there, the bands' keys, eight bits of every sample."""
    key = _band_keys(sig, np.arange(BANDS))
    low = (sig >> np.uint32(8)).astype(np.uint8)
    row = np.repeat(np.arange(len(sig)), BANDS)
    for b, at in C.split(C.bucket_of(key, buckets).ravel()):
        yield b, row[at], key.ravel()[at], low[row[at]].ravel()


def _bands(buckets: int):
    """Band keys with document, text hash and eight bits of every sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                held = [C.unpack(x.as_py()) for x in batch.column(2)]
                if held:
                    d, t, sig = (np.concatenate(x) for x in zip(*held))
                    for b, own, key, low in _dealt(sig.reshape(-1, BINS), buckets):
                        yield b, 0, C.pack([], [d[own], t[own], key, low])

        yield from C.packed_batches(rows())

    return run


def _packed_labels(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                node, label = (batch.column(i).to_numpy(zero_copy_only=False).view(U64) for i in (0, 1))
                for b, at in C.split(C.bucket_of(node, buckets)):
                    yield b, 0, C.pack([], [node[at], label[at]])

        yield from C.packed_batches(rows())

    return run


def _labelled_bands(buckets: int):
    """Band keys with text hash, the label of the text's class so far (its own hash where it has none) and eight bits of every sample."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {0: [], 1: []}
        for kind, blob in rows:
            parts[kind].append(C.unpack(blob))
        if not parts[1]:
            return
        _, t, sig = (np.concatenate(x) for x in zip(*parts[1]))
        sig = sig.reshape(-1, BINS)
        order = np.lexsort((sig[:, 0], t))  # equal texts once, with both signatures
        at = order[np.r_[True, (t[order][1:] != t[order][:-1]) | (sig[order, 0][1:] != sig[order, 0][:-1])]]
        t, sig = t[at], sig[at]
        label = t.copy()
        if parts[0]:
            node, value = (np.concatenate(x) for x in zip(*parts[0]))
            order = np.argsort(node)
            node, value = node[order], value[order]
            place = np.minimum(np.searchsorted(node, t), len(node) - 1)
            label = np.where(node[place] == t, value[place], t)

        def out() -> Iterator[tuple[int, int, bytes]]:
            for i in range(0, len(t), 4096):
                for b, own, key, low in _dealt(sig[i : i + 4096], buckets):
                    yield b, 0, C.pack([], [t[i : i + 4096][own], label[i : i + 4096][own], key, low])

        yield from C.packed_batches(out())

    return fn


def _alike(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sampled similarity of rows a with rows b."""
    out = np.empty(len(a), np.float32)
    for i in range(0, len(a), 16384):
        out[i : i + 16384] = (low[a[i : i + 16384]] == low[b[i : i + 16384]]).mean(1)
    return out


def _central(rows: np.ndarray, first: np.ndarray, nth: np.ndarray, low: np.ndarray, way: np.ndarray) -> np.ndarray:
    """Of each group (its first place, and the group of each place) the place of the row most alike, in the bins of its way,
    to the group's first, middle and last; of equal ones the first, or the last for odd ways."""
    last = np.r_[first[1:], len(rows)] - 1
    near = np.zeros(len(rows), np.int64)
    some = np.flatnonzero((last - first)[nth] > 1)
    for other in (first, (first + last) // 2, last):
        a, b = rows[some], rows[other[nth[some]]]
        for i in range(0, len(a), 16384):
            k = slice(i, i + 16384)
            near[some[k]] += ((low[a[k]] == low[b[k]]) & HALVES[way[a[k]]]).sum(1)
    place = np.arange(len(rows))
    return np.lexsort((np.where(way[rows] & 1, -place, place), -near, nth))[first]


def candidate_pairs(group: np.ndarray, low: np.ndarray, way: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to verify (leader, other) as row numbers. Rows are ordered by group, then by document; group: consecutive
    numbers of bands shared; way: how the group of each row chooses its central text."""
    way = np.zeros(len(group), np.int64) if way is None else way
    rows = np.arange(len(group))
    left, right = [], []
    turn = 0
    while len(rows) and turn < LEADERS:
        head = np.r_[True, group[1:] != group[:-1]]
        first, nth = np.flatnonzero(head), np.cumsum(head) - 1
        lead = (_central(rows, first, nth, low, way) if turn < CENTRAL_TURNS else first)[nth]
        rest = np.flatnonzero(np.arange(len(rows)) != lead)
        if not len(rest):
            break
        alike = _alike(low, rows[rest], rows[lead[rest]])
        hit = rest[alike >= MAYBE]
        left.append(rows[lead[hit]])
        right.append(rows[hit])
        stay = rest[alike < CLOSE]
        group, rows = group[stay], rows[stay]
        turn += 1
    if not left:
        return rows[:0], rows[:0]
    return np.concatenate(left), np.concatenate(right)


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    return np.stack([a[new], b[new]], 1)


def _pairs(buckets: int):
    """Candidate pairs of the texts that meet in a bucket's bands, to the bucket of the later text."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        ids, tid, key, low = (np.concatenate(x) for x in zip(*(C.unpack(b) for _, b in rows)))
        low = low.reshape(-1, BINS)
        order = np.lexsort((tid, ids, key))
        # each text once in a band
        same = np.r_[False, (key[order][1:] == key[order][:-1]) & (tid[order][1:] == tid[order][:-1])] if len(order) else np.zeros(0, bool)
        order = order[~same]
        ids, tid, key = ids[order], tid[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        at = np.flatnonzero(many)
        if not len(at):
            return
        _, g = np.unique(group[at], return_inverse=True)
        a, b = candidate_pairs(g, low[order[at]], (key[at] >> U64(8) & U64(3)).astype(np.int64))
        a, b = tid[at[a]], tid[at[b]]
        ok = a != b
        pair = distinct_pairs(a[ok], b[ok])
        if len(pair):
            yield from C.packed_batches((t, 1, C.pack([], [pair[k, 0], pair[k, 1]])) for t, k in C.split(C.bucket_of(pair[:, 1], buckets)))

    return fn


def cross_pairs(group: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group that have different labels, in parts. Rows are ordered by group, then by label."""
    n = len(group)
    if not n:
        return
    new = np.r_[True, group[1:] != group[:-1]]
    step = new | np.r_[True, label[1:] != label[:-1]]
    end = np.r_[np.flatnonzero(new)[1:], n][np.cumsum(new) - 1]
    own = np.r_[np.flatnonzero(step)[1:], n][np.cumsum(step) - 1]
    count = end - own
    before = np.r_[0, np.cumsum(count)]
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(before, before[i] + (1 << 20), "right")) - 1)
        if before[j] > before[i]:
            yield np.repeat(np.arange(i, j), count[i:j]), C.ranges(own[i:j], count[i:j])
        i = j


def agreeing(low: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows by token (a bin and its sample), in parts: any two rows that agree in `least` bins or more have a token in
    common here. Each row's rarest tokens are enough; of equally rare ones the smaller."""
    n = len(low)
    token = low.astype(np.int64) + np.arange(BINS) * 256
    times = np.bincount(token.ravel(), minlength=256 * BINS)
    rank = np.empty(256 * BINS, np.int64)
    rank[np.lexsort((np.arange(256 * BINS), times))] = np.arange(256 * BINS)
    short = BINS - least + 1
    mine = np.empty((n, short), np.int32)
    for i in range(0, n, 16384):
        r = rank[token[i : i + 16384]]
        mine[i : i + 16384] = np.partition(r, short - 1, 1)[:, :short]
    row = np.repeat(np.arange(n), short)
    order = np.lexsort((row, mine.ravel()))
    yield mine.ravel()[order], row[order]


def _cross(buckets: int):
    """Candidate pairs of texts that share a band and are of different classes so far, to the bucket of the larger hash."""
    least = int(np.ceil(MAYBE * BINS))

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        tid, label, key, low = (np.concatenate(x) for x in zip(*(C.unpack(b) for _, b in rows)))
        low = low.reshape(-1, BINS)
        order = np.lexsort((tid, label, key))
        tid, label, key = tid[order], label[order], key[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[head, len(key)])
        few = np.repeat(size < PREFIX_FROM, size)
        at = np.flatnonzero(few)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for a, b in cross_pairs(key[at], label[at]):
                yield at[a], at[b]
            for i, n in zip(head[size >= PREFIX_FROM], size[size >= PREFIX_FROM]):
                if label[i] == label[i + n - 1]:
                    continue
                for token, row in agreeing(low[order[i : i + n]], least):
                    for a, b in cross_pairs(token, label[i + row]):
                        yield i + row[a], i + row[b]

        node, place = np.unique(tid, return_inverse=True)
        for a, b in pairs():
            hit = _alike(low, order[a], order[b]) >= MAYBE
            x, y = place[a[hit]], place[b[hit]]
            if len(x):
                once = np.unique(np.minimum(x, y) * len(node) + np.maximum(x, y))
                pair = node[np.stack([once // len(node), once % len(node)], 1)]
                yield from C.packed_batches((t, 1, C.pack([], [pair[k, 0], pair[k, 1]])) for t, k in C.split(C.bucket_of(pair[:, 1], buckets)))

    return fn


def _distinct(buckets: int):
    """Pairs once (kind 1), and requests (kind 2): which texts each bucket needs, to the texts' buckets."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        pair = distinct_pairs(*(np.concatenate(x) for x in zip(*(C.unpack(b) for _, b in rows))))
        out = [(bucket, 1, C.pack([], [pair[:, 0], pair[:, 1]]))]
        need = np.unique(pair[:, 0])
        out += [(t, 2, C.pack([np.array([bucket])], [need[k]])) for t, k in C.split(C.bucket_of(need, buckets))]
        yield from C.packed_batches(iter(out))

    return fn


def _packed_texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, bytes]]:
            for batch in batches:
                tid = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
                _, keep = np.unique(tid, return_index=True)
                for b, k in C.split(C.bucket_of(tid[keep], buckets)):
                    at = keep[k]
                    data, off = C.text_bytes(batch.column(2).take(pa.array(at)))
                    yield b, 9, C.pack([np.diff(off), data], [tid[at]])

        yield from C.packed_batches(rows())

    return run


def _answer(buckets: int):
    """The texts asked for, once to each bucket that asked."""

    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list[int]] = {}
        held: dict[int, list] = {}

        def out() -> Iterator[tuple[int, int, bytes]]:
            for kind, blob in rows:
                if kind == 2:
                    to, need = C.unpack(blob)
                    for t in need.tolist():
                        asked.setdefault(t, []).append(int(to[0]))
                    continue
                if not asked:
                    break
                size, data, tid = C.unpack(blob)
                off = np.r_[0, np.cumsum(size)]
                for i, t in enumerate(tid.tolist()):
                    for to in asked.pop(t, ()):
                        part = held.setdefault(to, [[], [], 0])
                        part[0].append(t)
                        part[1].append(data[off[i] : off[i + 1]])
                        part[2] += int(size[i])
                        if part[2] > 1 << 20:
                            yield to, 5, pack(held.pop(to))
            for to, part in held.items():
                yield to, 5, pack(part)

        def pack(part: list) -> bytes:
            return C.pack([np.array([len(x) for x in part[1]], np.int64), np.concatenate(part[1])], [np.array(part[0], U64)])

        yield from C.packed_batches(out())

    return fn


def weighted_jaccard(h: np.ndarray, w: np.ndarray, g: np.ndarray, v: np.ndarray) -> float:
    """Of two sets of distinct hashes in order, with their weights."""
    at = np.searchsorted(g, h)
    at[at == len(g)] = 0
    both = g[at] == h if len(g) else np.zeros(len(h), bool)
    least = np.minimum(w[both], v[at[both]]).sum()
    return float(least / max(1e-12, w.sum() + v.sum() - least))


def _verify(idf: Idf, threshold: float):
    def fn(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        pairs: dict[int, list[int]] = {}
        lead: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found: list[tuple[int, int, float]] = []

        def sets(blob: bytes, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            size, data, tid = C.unpack(blob)
            off = np.r_[0, np.cumsum(size)]
            mine = np.array([i for i, t in enumerate(tid.tolist()) if t in wanted], np.int64)
            data, off, tid = data[C.ranges(off[mine], size[mine])], np.r_[0, np.cumsum(size[mine])], tid[mine]
            for i, j in C.text_runs(off):
                doc, h, tf = shingles(data[off[i] : off[j]], off[i : j + 1] - off[i])
                w = tf * idf.of(h)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                for n in range(j - i):
                    yield int(tid[i + n]), h[cut[n] : cut[n + 1]], w[cut[n] : cut[n + 1]]

        for kind, blob in rows:
            if kind == 1:
                a, b = C.unpack(blob)
                for x, y in zip(a.tolist(), b.tolist()):
                    pairs.setdefault(y, []).append(x)
            elif not pairs:
                break
            elif kind == 5:
                wanted = {x for v in pairs.values() for x in v} if not lead else wanted  # noqa: F821
                lead.update((t, (h, w)) for t, h, w in sets(blob, wanted))
            else:
                for t, h, w in sets(blob, pairs):
                    for x in pairs.pop(t, ()):
                        g, v = lead[x]
                        s = weighted_jaccard(h, w, g, v)
                        if s >= threshold:
                            found.append((x, t, s))
        if found:
            a, b, s = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, U64).view(np.int64)), pa.array(np.array(b, U64).view(np.int64)), pa.array(s)], names=["a", "b", "similarity"])

    return fn


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, tid (a hash of the text) and text."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text, F.octet_length(text)).alias("tid"), text.alias("text"))


def links(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs of different texts (a, b: hashes of the texts) that connect each class: those with leaders, then those
    between texts of a band that the links with leaders have left in different classes."""
    spark = docs.sparkSession
    n = C.partitions(spark)
    rows = _rows(docs)
    idf = idf_of(rows, docs.count())
    texts = C.map_batches(rows, _packed_texts(n), C.PACKED_SQL)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = C.stored(C.by_bucket(pairs, _distinct(n), C.PACKED_SQL), name)
        leaders = C.by_bucket(texts.unionByName(pairs.where("kind = 2")), _answer(n), C.PACKED_SQL)
        out = C.by_bucket(texts.unionByName(pairs.where("kind = 1")).unionByName(leaders), _verify(idf, threshold), "a long, b long, similarity double")
        return C.stored(C.map_batches(out.select("a", "b"), _forest, "a long, b long"), f"{name}_links")

    sketches = C.stored(C.map_batches(rows, _sketches(idf, n), C.PACKED_SQL), "sketches")
    first = verified(C.by_bucket(C.map_batches(sketches, _bands(n), C.PACKED_SQL), _pairs(n), C.PACKED_SQL), "pairs")
    labels = C.map_batches(components(first).select("node", "label"), _packed_labels(n), C.PACKED_SQL)
    bands = C.by_bucket(sketches.unionByName(labels), _labelled_bands(n), C.PACKED_SQL)
    return first.unionByName(verified(C.by_bucket(bands, _cross(n), C.PACKED_SQL), "cross"))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's links (a, b) those that connect what the ones before them don't: classes stay the same, and a group
    that many leaders are linked to has a row a member, not a row a link."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = p
        return x

    for batch in batches:
        keep = []
        for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            ra, rb = root(a), root(b)
            if ra != rb:
                up[rb] = ra
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def components(edges: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """Of each node of edges (a, b) its component: doc and label, the first of the component's nodes by doc, then node.
    least: node and doc of all nodes (without: all docs are 0). Labels spread to neighbours and jump along themselves, so
    the rounds grow with the logarithm of a path's length; each round's labels are a table."""
    edges = C.stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).distinct()
    nodes = nodes.withColumn("doc", F.lit(0).cast("long")) if least is None else nodes.join(least, "node").select("node", "doc")
    nodes = C.stored(nodes.select("node", F.struct("doc", "node").alias("label")), "labels")
    labels = nodes
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("best"))
        spread = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "best").alias("next"), "label")
        up = labels.select(F.col("node").alias("n"), F.col("label").alias("up"))
        jumped = spread.join(up, spread["next.node"] == up["n"], "left").select("node", F.least("next", F.coalesce("up", "next")).alias("label"), F.col("label").alias("old"))
        labels = C.stored(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", F.col("label.doc").alias("doc"), F.col("label.node").alias("label"))
        labels = labels.select("node", "label")


def _texts(docs: DataFrame, threshold: float) -> DataFrame:
    """Of each text (node) the first of its class: doc (NO_ID: null) and label (the text's hash). A table with a row a text."""
    rows = _rows(docs)
    least = C.stored(rows.groupBy(F.col("tid").alias("node")).agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("doc")), "texts")
    found = components(links(docs, threshold), least).select(F.col("node").alias("n"), F.col("doc").alias("d"), "label")
    return C.stored(least.join(found, least["node"] == found["n"], "left").select("node", F.coalesce("d", "doc").alias("doc"), F.coalesce("label", "node").alias("label")), "classes")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, tid, class_id and label (the hash of the class's first text) of each of docs (doc_id, text)."""
    texts = _texts(docs, threshold)
    rows = _rows(docs).select("doc_id", "tid")
    return rows.join(texts, rows["tid"] == texts["node"]).select("doc_id", "tid", F.when(F.col("doc") != NO_ID, F.col("doc")).alias("class_id"), "label")


def dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, less all but one of each class: the one with the least doc_id (of equal doc_ids the
    one whose text has the least hash; of equal rows one)."""
    names = docs.columns
    texts = _texts(docs, threshold)
    kept = texts.where("node = label").select(F.col("doc").alias("kept_doc"), F.col("label").alias("kept_text"))
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text, F.octet_length(text)).alias("t"), F.struct(*[C.column(docs, c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row"))
    rows = rows.join(kept, (rows["d"] == kept["kept_doc"]) & (rows["t"] == kept["kept_text"])).groupBy("d", "t").agg(F.first("row").alias("row"))
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
