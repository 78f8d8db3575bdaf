"""Hard negatives against brute force, odd rows, pruning."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import hard_negatives as H


def brute(rows, every, k, m, share):
    fine = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v, *_ in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, y, v in fine:
        if a % every:
            continue
        s = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in fine if i != a and len(w) == len(v))
        for ps, p in [(-x, i) for x, i, z in s if z == y][:k]:
            hard = [(i, -x) for x, i, z in s if z != y and share * ps <= -100 * x <= 100 * ps][:m]
            out += [(a, p, n + 1, i, ps, x) for n, (i, x) in enumerate(hard)]
    return sorted(out)


SCHEMA = "vec_id long, label int, embedding array<double>, v int, `rank.x` string"


def check(spark, rows, every=10, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = sorted(tuple(r) for r in H.mine(df, F.col("label"), every).collect())
    assert got == brute(rows, every, 5, 5, 80)
    return got


def test_against_brute_force(spark, monkeypatch):
    r = random.Random(2)
    centre = [[r.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = [(i, r.randrange(4), [c + r.gauss(0, 0.3) for c in centre[i % 6]], 0, "a") for i in range(500)]
    rows += [(1000 + i, i % 3, rows[40][2], 0, "b") for i in range(150)]  # copies, ties
    rows += [(2000, 1, None, 0, ""), (2010, None, rows[3][2], 0, ""), (2020, 1, [1.0, None] + [0.0] * 10, 0, ""), (2030, 1, [math.nan] * 12, 0, ""), (2040, 1, [math.inf] * 12, 0, ""), (None, 1, rows[3][2], 0, "")]
    rows += [(2050, 1, [1.0, 2.0], 0, ""), (2051, 1, [1.5, 2.0], 0, ""), (2052, 2, [1.0, 2.0], 0, ""), (2060, 1, [], 0, ""), (2061, 1, [], 0, ""), rows[20], rows[7]]
    assert len(check(spark, rows)) > 300
    monkeypatch.setattr(H, "WAVE_BYTES", 3000)  # several waves
    check(spark, rows, 50, 2)
    assert H.mine(spark.createDataFrame([], SCHEMA), F.col("label")).count() == 0


def test_many_labels_and_large_components(spark):
    r = random.Random(3)
    check(spark, [(i, r.randrange(80), [r.gauss(0, 1) for _ in range(6)], 0, "") for i in range(400)])
    check(spark, [(i, i % 3, [r.gauss(0, 5000) for _ in range(4)], 0, "") for i in range(120)])


def test_whole_groups_are_pruned(monkeypatch):
    r = np.random.default_rng(1)
    centres = r.normal(0, 4000, (20, 16))
    rows = np.floor(centres[r.integers(0, 20, 8000)] + r.normal(0, 60, (8000, 16))).astype(np.int64)
    labels = r.integers(0, 5, 8000)
    tree = H.Tree(np.arange(400), labels[:400], rows[:400], 4)
    job = H.Search(tree, np.full((400, 1), -np.inf), np.full((400, 1), np.inf), 5, True)
    scored = []
    plain = H.Search._score
    monkeypatch.setattr(H.Search, "_score", lambda self, a, b, score, *x: (scored.append(score.size), plain(self, a, b, score, *x)))
    job.add(H.Tree(np.arange(8000), labels, rows, 32))
    window, score, ids = job.best
    want = rows[:400] @ rows.T
    for a in range(400):
        own = np.flatnonzero((labels == labels[tree.ids[a]]) & (np.arange(8000) != tree.ids[a]))
        best = sorted(zip(-want[tree.ids[a], own], own))[:5]
        assert sorted(zip(-score[window == a], ids[window == a])) == best
    assert sum(scored) < 400 * 8000 / 10  # of the same labels' fifth less than a half
