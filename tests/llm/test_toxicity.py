"""Toxic passages against plain versions: segments with negative tokens, the score of a text, stems, copies, clean()."""

import math
import random
import time

import numpy as np
import pytest

from corpusloom.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def plain_segments(full):
    def maximal(a, b):  # by definition: the best run, then the best to its left and right
        best = max(((sum(full[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
        return [] if best[0] <= 1e-12 else maximal(a, best[2]) + [best[0]] + maximal(best[3], b)

    return maximal(0, len(full))


def test_segments_with_negative_tokens():
    r = random.Random(1)
    for _ in range(300):
        n = r.randrange(1, 30)
        s = [r.choice((2.25, 1.125, -1.5, None, None)) for _ in range(n)]
        at = np.array([i for i in range(n) if s[i] is not None], np.int64)
        got = T.maximal_segments(at, np.array([s[i] for i in at], float), 0.7)
        assert np.allclose(sorted(x for *_, x in got), sorted(plain_segments([-0.7 if x is None else x for x in s])))


def word(r, n=3):
    return "".join(r.choice(["tha", "on", "re", "it", "sh", "la"]) for _ in range(r.randrange(1, n + 1)))


def corpus(r, rows, copies=0):
    """Toxic documents hold words of two stems with any endings; a third of all rows may be copies of one toxic document."""
    docs, labels = [], []
    for i in range(rows):
        t = [word(r) for _ in range(r.randrange(20, 80))]
        if y := i % 6 == 0:
            for _ in range(r.randrange(2, 6)):
                t.insert(r.randrange(len(t)), r.choice(("loweq", "vaxu")) + word(r, 2))
        docs.append((i, " ".join(t)))
        labels.append((i, 1 - y, int(y)))
    for k in range(copies):
        docs.append((rows + k, docs[0][1] + " " + word(r)))
        labels.append((rows + k, 0, 1))
    return docs, labels


def held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.mark.parametrize("copies", [0, 300])
def test_stems_are_found_and_copies_are_no_evidence(spark, copies):
    docs, labels = corpus(random.Random(3), 900, copies)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    model = T.fit(d, lab)
    got = [r for r in T.score(d, model).collect() if r.held_out and r.doc_id < 900]
    assert len(got) > 180 and all(r.held_out == held(r.doc_id) for r in got)
    truth = {i: y for i, _, y in labels}
    caught = np.mean([r.predicted for r in got if truth[r.doc_id]])
    clean = np.mean([not r.predicted for r in got if not truth[r.doc_id]])
    assert caught >= 0.9 and clean >= 0.95


def test_score_against_a_plain_version(spark):
    docs, labels = corpus(random.Random(5), 600)
    docs += [(9000, None), (9001, ""), (9002, "loweqsh " * 4000), (None, "Loweqon la"), docs[6]]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    m = T.fit(d, spark.createDataFrame(labels, LABELS))
    odds = dict(zip(m.words.tolist(), m.odds.tolist()))

    def plain(text):
        raw = (text or "").encode()
        data = np.frombuffer(raw, np.uint8)
        t = T.tokens(data, np.array([0, len(data)]))
        full = []
        for k in range(len(t.start)):
            value = 0.0
            for which, h in t.levels(np.array([k])):
                if len(which) and int(h[0]) in odds:
                    value = odds[int(h[0])]
            full.append(value - m.drift)
        best, run = 0.0, 0.0
        for x in full:  # the best run of all
            run = max(0.0, run + x)
            best = max(best, run)
        x = m.scale * best - math.log(max(1, len(full)))
        return x

    by = {}
    for r in T.score(d, m).collect():
        by.setdefault((r.doc_id, r.held_out), []).append(r)
    for i, text in docs[::37] + docs[-5:]:
        r = by[(i, i is not None and held(i))][0]
        want = m.chance(np.array([plain(text)]), np.array([float(len(r.passages))]))[0]
        assert abs(want - r.score) < 1e-6
        raw = (text or "").encode()
        assert all(raw[p.start : p.end].decode() == raw[p.start : p.end].decode().strip() for p in r.passages)
    assert len(by[(docs[6][0], held(docs[6][0]))]) == 2


def test_clean_keeps_columns_of_any_name(spark):
    docs, labels = corpus(random.Random(7), 600)
    rows = [(f"s{i}", t, i, 0.5, 1, "v") for i, t in docs] + [("n", None, None, None, None, None), ("e", "", 5000, 0.0, 0, "")]
    d = spark.createDataFrame(rows, "`a b` string, text string, doc_id long, score double, y int, sketch string")
    lab = spark.createDataFrame(labels, LABELS)
    kept = T.clean(d, T.fit(d, lab))
    assert kept.columns == d.columns
    got = {r.doc_id for r in kept.collect()}
    truth = {i: y for i, _, y in labels}
    assert None in got and 5000 in got
    assert np.mean([i not in got for i, y in truth.items() if y]) >= 0.9 and np.mean([i in got for i, y in truth.items() if not y]) >= 0.95
    assert T.clean(d.limit(0), T.Model()).count() == 0


def test_segments_of_a_million_isolated_tokens_take_seconds():
    n = 1_000_000
    start = time.time()
    for at, score in ((np.arange(n) * 100, np.ones(n)), (np.arange(n), np.tile([1.0, -2.0], n // 2)), (np.arange(n) * 3, np.linspace(1, 2, n)), (np.arange(n) * 3, np.linspace(2, 1, n))):
        assert T.maximal_segments(at, score, 0.7)
    assert time.time() - start < 40
