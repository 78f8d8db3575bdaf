"""Sets within a document that overlap, compared batch by batch as products of 0/1 matrices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Sets of a document whose matrix is multiplied at once.
BLOCK = 512


def pairs(sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int, float]]:
    """Numbers a < b of sets of distinct values, and their Jaccard similarity where that is at least `least`."""
    if len(sets) < 2:
        return
    size = np.array([len(x) for x in sets])
    _, value = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    for i in range(0, len(sets), BLOCK):
        mine = (owner >= i) & (owner < i + BLOCK)
        seen, column = np.unique(value[mine], return_inverse=True)
        left = np.zeros((min(BLOCK, len(sets) - i), len(seen)), np.float32)
        left[owner[mine] - i, column] = 1
        for j in range(i, len(sets), BLOCK):
            other = (owner >= j) & (owner < j + BLOCK) & np.isin(value, seen)
            right = np.zeros((min(BLOCK, len(sets) - j), len(seen)), np.float32)
            right[owner[other] - j, np.searchsorted(seen, value[other])] = 1
            both = left @ right.T
            share = both / (size[i : i + BLOCK, None] + size[None, j : j + BLOCK] - both)
            for a, b in zip(*np.nonzero(share >= least)):
                if i + a < j + b:
                    n = float(both[a, b])
                    yield int(i + a), int(j + b), n / (float(size[i + a]) + float(size[j + b]) - n)


def alike(least: float, smallest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, a, b and jaccard of the pairs of a document's sets (lists of distinct numbers, no null) of `smallest` values or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            outer = lists.offsets.to_numpy()
            inner = lists.values.offsets.to_numpy()
            flat = lists.values.values.to_numpy(zero_copy_only=False)
            got: list[tuple] = []
            for n, doc in enumerate(batch.column(0).to_pylist()):
                rows = range(outer[n], outer[n + 1]) if lists[n].is_valid else ()
                place = [(k - outer[n], flat[inner[k] : inner[k + 1]]) for k in rows if inner[k + 1] - inner[k] >= smallest]
                got += [(doc, place[a][0], place[b][0], round(j, 6)) for a, b, j in pairs([x for _, x in place], least)]
            doc, a, b, j = zip(*got) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(j, pa.float64())], names=["doc_id", "a", "b", "jaccard"])

    return run
