"""SentencePiece encoding by forward filtering and backward sampling over the piece lattice, and lossless decoding.

The model file gives the pieces; they are never trained here. A blank is the model's mark for one, a blank is put before
each text, and characters without a piece fall back to their bytes. No piece goes on after a blank that follows other
characters, so the lattice of a text falls apart into those of its *units*: blanks and the characters up to the next
blank, line end or tab, however long. The forward pass sums, for each distinct unit of
a batch, the weights of all segmentations up to each byte (of units beyond UNIT_BYTES their logarithms, as such sums underflow); backward sampling then draws, for every occurrence, one edge
after the other from the end. The draws come from a hash of seed, row key, unit number and step: a row's segmentation is
always the same, wherever it is computed. A piece's weight falls with its rank in the model by Zipf's law; `alpha` is
the power (large: close to the best segmentation, small: more even).

Decoding joins the pieces' texts and drops the first blank. It is lossless for every valid text, the mark itself
included (it goes by bytes).

Defined results: null and empty texts have no pieces and decode to empty text; a null row key has a seed of its own;
repeated rows get equal pieces; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as C

U64 = np.uint64
#: Where public vocabulary files are; a parameter of every function.
MODEL = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/piece_bpe_32k.model"
UNIT_BYTES = 64
RUN_BYTES = 1 << 20
SLOT_BITS = 18
ALPHA = 1.0
BYTE_WEIGHT = 1e-5
_CUT = np.zeros(256, bool)
_CUT[[9, 10, 11, 12, 13]] = True


class Vocabulary:
    """Hashes, ids and weights of the pieces, by length in bytes; a blank stands for the mark."""

    def __init__(self, model: str, alpha: float) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.byte_id = np.full(256, -1, np.int32)
        texts: list[bytes] = []
        hashes, ids = [], []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append(b"")
            else:
                texts.append(piece.replace("▁", " ").encode())
                ids.append(i)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.place = np.cumsum(self.sizes) - self.sizes
        ids = np.array(ids, np.int32)
        h = C.span_hash(C.prefix(C.T1[self.text]), self.place[ids], self.place[ids] + self.sizes[ids])
        order = np.argsort(h)
        self.hash, self.id = h[order], ids[order]
        self.lengths = np.unique(self.sizes[ids]).tolist()
        # the first of the sorted hashes that begin with the same SLOT_BITS bits, and the most that do
        head, first, run = np.unique((self.hash >> U64(64 - SLOT_BITS)).astype(np.int64), return_index=True, return_counts=True)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slot[head] = first
        self.run = int(run.max())
        rank = np.empty(n)
        rank[ids] = np.arange(len(ids))
        self.weight = np.full(n, BYTE_WEIGHT)
        self.weight[ids] = (rank[ids] + 3.0) ** -alpha

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these hashes are pieces', and the pieces' ids."""
        i = self.slot[(h >> U64(64 - SLOT_BITS)).astype(np.int64)]
        k = np.flatnonzero(i >= 0)
        i, want = i[k], h[k]
        for _ in range(1, self.run):
            i = np.where((self.hash[i] < want) & (i + 1 < len(self.hash)), i + 1, i)
        ok = np.flatnonzero(self.hash[i] == want)
        return k[ok], self.id[i[ok]]


@functools.lru_cache(4)
def vocabulary(model: str = MODEL, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(model, alpha)


def units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a blank before each text that isn't empty, offsets of the texts, and starts of the units."""
    size = np.diff(off)
    grown = np.r_[0, np.cumsum(size + (size > 0))]
    out = np.full(grown[-1], 32, np.uint8)
    first = grown[:-1][size > 0]
    inner = np.ones(len(out), bool)
    inner[first] = False
    out[inner] = data
    blank = out == 32
    begin = np.zeros(len(out), bool)
    begin[first] = True
    begin[1:] |= blank[1:] & ~blank[:-1]
    cut = _CUT[out]
    begin |= cut
    begin[1:] |= cut[:-1]
    start = np.flatnonzero(begin)
    return out, grown, start


class Lattice:
    """Edges of all units (bytes `text`, unit u from off[u] to off[u + 1]) in the order of the node they end in. A node is
    a place in the bytes plus the number of its unit, so that every unit has a node of its own for its end. deep: units are
    of any length, and weights are summed as logarithms."""

    def __init__(self, v: Vocabulary, text: np.ndarray, off: np.ndarray, deep: bool = False) -> None:
        n = np.diff(off)
        unit = np.repeat(np.arange(len(n)), n)
        left = np.repeat(off[1:], n) - np.arange(len(text))
        pre = C.prefix(C.T1[text])
        begins, lengths, pieces = [], [], []
        covered = np.zeros(len(text), bool)
        width = np.where(text < 0xC0, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        at = np.arange(len(text))[(text & 0xC0) != 0x80]
        for size in v.lengths:
            at = at[left[at] >= size]
            if not len(at):
                break
            h = C.span_hash(pre, at, at + size)
            k, found = v.find(h)
            p = at[k]
            begins.append(p)
            lengths.append(np.full(len(p), size))
            pieces.append(found)
            covered[p[width[p] == size]] = True
        bare = np.flatnonzero(((text & 0xC0) != 0x80) & ~covered)
        p = C.ranges(bare, np.minimum(width[bare], left[bare]))
        begins.append(p)
        lengths.append(np.ones(len(p), np.int64))
        pieces.append(v.byte_id[text[p]])
        begin, piece = np.concatenate(begins), np.concatenate(pieces)
        start = begin + unit[begin]
        end = start + np.concatenate(lengths)
        self.first, self.last = off[:-1] + np.arange(len(n)), off[1:] + np.arange(len(n))
        # by end, then in the order found; of that order, by the place in the unit (a byte's radix sort, for short units)
        bits = max(len(end), 1).bit_length()
        by_end = np.sort(end << bits | np.arange(len(end))) & ((1 << bits) - 1)
        start, end, piece = start[by_end], end[by_end], piece[by_end]
        local = (end - self.first[unit[begin[by_end]]])
        local = local if deep else local.astype(np.uint8)
        # forward filtering, one byte further in every unit at a time
        order = np.argsort(local, kind="stable")
        begins, ends, w = start[order], end[order], v.weight[piece][order]
        if deep:
            w = np.log(w)
        alpha = np.full(len(text) + len(n) + 1, -np.inf if deep else 0.0)
        alpha[self.first] = 0.0 if deep else 1.0
        moved = np.full(len(w), -np.inf if deep else 0.0)
        cut = np.r_[0, np.cumsum(np.bincount(local, minlength=1))]
        for i, j in zip(cut[:-1], cut[1:]):
            if i == j:
                continue
            f = alpha[begins[i:j]] + w[i:j] if deep else alpha[begins[i:j]] * w[i:j]
            moved[i:j] = f
            e = ends[i:j]
            head = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
            if deep:
                most = np.maximum.reduceat(f, head)
                most[np.isinf(most)] = 0.0
                part = np.exp(f - np.repeat(most, np.diff(np.r_[head, j - i])))
                with np.errstate(divide="ignore"):
                    alpha[e[head]] = most + np.log(np.add.reduceat(part, head))
            else:
                alpha[e[head]] = np.add.reduceat(f, head)
        flow = np.empty(len(w))
        flow[order] = moved
        keep = np.flatnonzero(flow > (-np.inf if deep else 0))
        self.start, self.piece, end = start[keep], piece[keep], end[keep]
        share = np.exp(flow[keep] - alpha[end]) if deep else flow[keep] / alpha[end]
        head = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else np.zeros(0, np.int64)
        count = np.diff(np.r_[head, len(end)])
        # of each node the first and the last edge, and of each edge the shares before it in its node
        self.low, self.high = np.zeros(len(alpha), np.int64), np.zeros(len(alpha), np.int64)
        self.low[end[head]], self.high[end[head]] = head, head + count - 1
        before = np.cumsum(share) - share
        self.before = before - np.repeat(before[head], count)

    def draw(self, node: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """An edge that ends in each node: the last whose shares before it don't exceed the chance. Long pieces, which are
        likely, are at a node's end, so the search goes down from there."""
        e, low = self.high[node], self.low[node]
        todo = np.flatnonzero((self.before[e] > chance) & (e > low))
        while len(todo):
            e[todo] -= 1
            at = e[todo]
            todo = todo[(self.before[at] > chance[todo]) & (at > low[todo])]
        return e


def sample_pieces(v: Vocabulary, data: np.ndarray, off: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, and where those of each begin and the last end."""
    text, grown, start = units(data, off)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    end = np.r_[start[1:], len(text)]
    h = C.span_hash(C.prefix(C.T1[text]), start, end)
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    size = (end - start)[one]
    doc = np.searchsorted(grown, start, "right") - 1
    number = np.arange(len(start)) - np.searchsorted(start, grown)[doc]
    key = C.mix(seed[doc] + number.astype(U64) * C.BASE)
    steps = []  # number of the step, units, pieces
    for deep in (False, True):
        mine = np.flatnonzero((size > UNIT_BYTES) == deep)
        if not len(mine):
            continue
        lattice = Lattice(v, text[C.ranges(start[one[mine]], size[mine])], np.r_[0, np.cumsum(size[mine])], deep)
        at = np.flatnonzero((size[which] > UNIT_BYTES) == deep)
        k = np.searchsorted(mine, which[at])
        node, first, seeds = lattice.last[k], lattice.first[k], key[at]
        n = 0
        while len(at):
            chance = (C.mix(seeds + U64(n + 1)) >> U64(11)).astype(np.float64) * 2.0**-53
            e = lattice.draw(node, chance)
            steps.append((n, at, lattice.piece[e]))
            node = lattice.start[e]
            go = np.flatnonzero(node != first)
            at, node, first, seeds = at[go], node[go], first[go], seeds[go]
            n += 1
    count = np.zeros(len(start), np.int64)
    for _, a, _ in steps:
        count[a] += 1
    place = np.cumsum(count) - 1
    out = np.empty(int(count.sum()), np.int32)
    for n, a, piece in steps:
        out[place[a] - n] = piece
    total = np.r_[0, np.cumsum(count)]
    return out, total[np.searchsorted(start, grown)]


def join_pieces(v: Vocabulary, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that these pieces make, and the texts' offsets."""
    size = v.sizes[ids]
    text = v.text[C.ranges(v.place[ids], size)]
    at = np.r_[0, np.cumsum(size)][off]
    some = np.flatnonzero(np.diff(at) > 0)
    keep = np.ones(len(text), bool)
    keep[at[:-1][some]] = False  # the blank put before the text
    n = np.diff(at)
    n[some] -= 1
    return text[keep], np.r_[0, np.cumsum(n)]


def encode(docs: DataFrame, model: str = MODEL, alpha: float = ALPHA, seed: int = 0, verify: bool = True) -> DataFrame:
    """doc_id, n_pieces, pieces (ids) and, with verify, whether they decode to the text, of each of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model, alpha)
        for batch in batches:
            key = C.mix(batch.column(1).to_numpy(zero_copy_only=False).view(U64) + U64(seed))
            data, off = C.text_bytes(batch.column(2))
            for i, j in C.text_runs(off, RUN_BYTES):
                d, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                ids, at = sample_pieces(v, d, o, key[i:j])
                cols = [batch.column(0).slice(i, j - i), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))]
                if verify:
                    back, where = join_pieces(v, ids, at)
                    same = np.diff(where) == np.diff(o)
                    if same.all():
                        wrong = np.r_[0, np.cumsum(back != d)]
                        same = wrong[o[1:]] == wrong[o[:-1]]
                    else:
                        same = np.array([back[a:b].tobytes() == d[c:e].tobytes() for a, b, c, e in zip(where[:-1], where[1:], o[:-1], o[1:])])
                    cols.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_pieces", "pieces", "lossless"][: len(cols)])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("\x00"))).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return C.map_batches(rows, run, "doc_id long, n_pieces long, pieces array<int>" + ", lossless boolean" * verify)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and pieces. Null pieces are empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            ids = batch.column(1)
            flat, off = ids.values.to_numpy(zero_copy_only=False), np.asarray(ids.offsets).astype(np.int64)
            text, at = join_pieces(v, flat[off[0] : off[-1]], off - off[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([text[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return C.map_batches(encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), F.coalesce(encoded["pieces"], F.array().cast("array<int>")).alias("pieces")), run, "doc_id long, text string")
