"""Near-duplicates against brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from corpusloom.llm import _common as C
from corpusloom.llm import near_dedup as N

SCHEMA = "doc_id long, text string, label string, tid int"


def fixture():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8)))
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(r.choice((3, 30, 120, 300)))]
        for _ in range(r.choice((1, 1, 2, 5, 12))):
            t = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 4))):
                t[r.randrange(len(t))] = word()
            rows.append((i, " ".join(t), "x", 1))
            i += 1
    r.shuffle(rows)
    return rows + [(900, None, "", 0), (901, "", "", 0), (902, " \n", "", 0), (None, rows[0][1], "", 0), rows[3], (903, "one two", "", 0), (904, "one two", "", 0), (905, "two one", "", 0)]


def brute(rows):
    """Classes by exact weighted Jaccard over all pairs of texts."""
    texts = sorted({t or "" for _, t, *_ in rows})
    raw = lambda t: N.shingles(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))
    count = {}
    for _, t, *_ in rows:
        for h in raw(t)[1].tolist():
            count[h] = count.get(h, 0) + 1
    least = max(2, math.ceil(N.FREQUENT * len(rows)))
    weigh = lambda h: 1 + N.SPAN * min(1.0, math.log(count[h] / len(rows)) / math.log(N.FREQUENT)) if count[h] >= least else 1 + N.SPAN
    sets = []
    for t in texts:
        _, h, tf = raw(t)
        sets.append({x: n * weigh(x) for x, n in zip(h.tolist(), tf.tolist())})
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and sum(min(x[h], y[h]) for h in x.keys() & y.keys()) / sum(max(x.get(h, 0), y.get(h, 0)) for h in x.keys() | y.keys()) >= 0.8:
                up[root(a)] = root(b)
    group = {t: root(i) for i, t in enumerate(texts)}
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[group[t or ""]] = min(d, least.get(group[t or ""], d))
    return sorted((-1 if d is None else d, least.get(group[t or ""], -1)) for d, t, *_ in rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_classes(spark, parts):
    rows = fixture()
    got = N.classes(spark.createDataFrame(rows, SCHEMA).repartition(parts)).select("doc_id", "class_id").collect()
    assert sorted((-1 if d is None else d, -1 if c is None else c) for d, c in got) == brute(rows)


def test_dedup_keeps_one_of_each_class(spark):
    rows = fixture()
    kept = N.dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert kept[0].__fields__ == ["doc_id", "text", "label", "tid"]
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in brute(rows)})


def test_long_texts_and_columns_of_any_name(spark):
    long = "some words that go on and on " * 20000
    rows = [(5, long + "a", 1, "t", 2, "q"), (3, long + "b c", 1, "t", 2, "q"), (9, "other", None, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, node long, label string, kept_doc int, `a b` string")
    assert {(r.doc_id, r.class_id) for r in N.classes(d).collect()} == {(5, 3), (3, 3), (9, 9)}
    kept = N.dedup(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [3, 9]


def test_empty(spark):
    assert N.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("draw", [N.binned, N.independent])
def test_sampling_agrees_with_similarity(draw):
    r = np.random.default_rng(1)
    got = []
    for _ in range(20):
        h = r.integers(0, 2**63, 1200).astype(np.uint64)
        w = 1 + N.SPAN * r.random(1200)
        a, b = np.arange(0, 1080), np.arange(120, 1200)
        sig = draw(np.r_[np.zeros(1080, np.int64), np.ones(1080, np.int64)], np.r_[h[a], h[b]], np.r_[w[a], w[b]], 2)
        got.append((sig[0] == sig[1]).mean() - np.minimum(w[120:1080], w[120:1080]).sum() / w.sum())
    assert abs(np.mean(got)) < 0.04 and np.std(got) < 0.1


def test_every_text_at_the_threshold_has_a_common_signature():
    r = np.random.default_rng(3)
    for n in (1, 7, 20, 250, 300, 330, 390, 420, 900):
        h, tf = np.sort(r.integers(0, 2**63, n).astype(np.uint64)), np.full(n, int(r.integers(1, 4)))
        m = math.ceil(n * 0.85)
        which, sig = N.signatures(np.r_[np.zeros(n, np.int64), np.ones(m, np.int64)], np.r_[h, h[:m]], np.r_[tf, tf[:m]], np.ones(n + m), 2)
        assert max(float((sig[i] == sig[j]).mean()) for i in np.flatnonzero(which == 0) for j in np.flatnonzero(which == 1)) > 0.5


def test_heavy_shingles_weigh_by_their_count():
    h = np.arange(1, 302, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tf = np.r_[2000, np.ones(300, int)]
    which, sig = N.signatures(np.r_[np.zeros(301, np.int64), np.ones(1, np.int64)], np.r_[h, h[:1]], np.r_[tf, tf[:1]], np.ones(302), 2)
    assert which.tolist() == [0, 1] and abs((sig[0] == sig[1]).mean() - 2000 / 2300) < 0.2


def test_prefix_filter_loses_no_pair_that_agrees():
    r = np.random.default_rng(5)
    base = r.integers(0, 256, (12, N.BINS))
    low = base[r.integers(0, 12, 400)]
    low = np.where(r.random(low.shape) < r.choice([0.1, 0.3, 0.5], (400, 1)), r.integers(0, 256, low.shape), low).astype(np.uint8)
    least = math.ceil(N.MAYBE * N.BINS)
    found = set()
    for token, row in N.agreeing(low, least):
        for a, b in N.cross_pairs(token, row):
            found |= {(min(row[x], row[y]), max(row[x], row[y])) for x, y in zip(a, b)}
    want = {(a, b) for a in range(400) for b in range(a + 1, 400) if (low[a] == low[b]).sum() >= least}
    assert len(want) > 1000 and want <= found


@pytest.mark.parametrize("prefix_from", [4, 10**9])
def test_link_recall_on_planted_pairs(spark, monkeypatch, prefix_from):
    """Hundreds of pairs at all similarities around the threshold, short and long, some in large groups."""
    monkeypatch.setattr(N, "PREFIX_FROM", prefix_from)
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 8)))
    rows, i = [], 0
    passage = [word() for _ in range(60)]
    for b in range(260):
        base = [word() for _ in range(r.choice((6, 9, 12, 16, 25, 40, 80, 150, 300, 600)))]
        base = (passage if b % 5 == 0 else []) + base
        for k in range(r.choice((2, 2, 3, 6))):
            t = list(base)
            for p in r.sample(range(len(t)), min(len(t) // 6, r.randrange(0, 1 + len(t) // 30))):
                t[p] = word()
            if r.random() < 0.5:
                t = t[: len(t) - r.randrange(0, 1 + len(t) // 8)]
            rows.append((i, " ".join(t), "x", 0))
            i += 1
    want = brute(rows)
    got = dict(N.classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).select("doc_id", "class_id").collect())
    least = {}
    for d, c in want:
        least.setdefault(c, []).append(d)
    links = [(a, b) for g in least.values() for a, b in zip(g, g[1:])]
    assert len(links) > 300 and np.mean([got[a] == got[b] for a, b in links]) >= 0.99
    assert all(dict(want)[d] == dict(want)[c] for d, c in got.items())  # nothing unlike is joined


def test_candidates_of_a_large_alike_group_stay_linear():
    n = 3000
    low = np.tile(np.arange(N.BINS, dtype=np.uint8), (n, 1))
    a, b = N.candidate_pairs(np.zeros(n, np.int64), low)
    assert set(b.tolist()) == set(range(1, n)) and len(a) <= N.LEADERS * n


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 40), (40, 41), (41, 42), (42, 43)], "a long, b long")
    assert {(r.node, r.label) for r in N.components(e).collect()} == {(i, 1) for i in (1, 2, 3, 40, 41, 42, 43)} | {(8, 8), (9, 8)}
    least = spark.createDataFrame([(i, 100 - i) for i in (1, 2, 3, 8, 9, 40, 41, 42, 43, 99)], "node long, doc long")
    assert {tuple(r) for r in N.components(e, least).select("node", "doc", "label").collect()} == {(i, 57, 43) for i in (1, 2, 3, 40, 41, 42, 43)} | {(8, 91, 9), (9, 91, 9)}


def test_words_are_split_at_ascii_white_space():
    data = np.frombuffer("a b c\td".encode(), np.uint8)
    start, end, _ = C.words(data, np.array([0, len(data)]))
    assert [data[s:e].tobytes().decode() for s, e in zip(start, end)] == ["a b", "c", "d"]


def test_an_original_leads_copies_that_came_before_it(spark):
    """A close copy has the least id, a distant copy is alike to the original only."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))

    def edited(base, n):
        t = list(base)
        for p in r.sample(range(5, len(t) - 5), n):
            t[p] = word()
        return " ".join(t)

    rows = []
    for i in range(40):
        base = [word() for _ in range(200)]
        rows += [(10 * i, edited(base, 1), "x", 0), (10 * i + 5, " ".join(base), "x", 0), (10 * i + 9, edited(base, 4), "x", 0)]
    want = brute(rows)
    assert len({c for _, c in want}) < 60
    got = N.classes(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "class_id").collect()
    assert sum(a != b for a, b in zip(sorted(map(tuple, got)), want)) == 0


def test_copies_of_copies_are_linked_past_their_leader(spark):
    """A text is alike to one copy of a large group only, and that copy leaves its bands with another leader."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9)))

    def edited(base, places):
        t = list(base)
        for p in places:
            t[p] = word()
        return t

    rows = []
    for i in range(2):
        base = [word() for _ in range(200)]
        copies = [edited(base, [r.randrange(5, 195)]) for _ in range(80)]
        rows += [(1000 * i + k, " ".join(t), "x", 0) for k, t in enumerate([base, *copies])]
        rows += [(1000 * i + 900 + k, " ".join(edited(copies[k], r.sample(range(8, 192), 3))), "x", 0) for k in range(20)]
    r.shuffle(rows)
    got = N.classes(spark.createDataFrame(rows, SCHEMA).repartition(5)).select("doc_id", "class_id").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_cross_pairs_are_all_pairs_of_different_labels():
    r = np.random.default_rng(2)
    group, label = r.integers(0, 9, 200), r.integers(0, 4, 200)
    order = np.lexsort((label, group))
    group, label = group[order], label[order]
    got = [p for a, b in N.cross_pairs(group, label) for p in zip(a.tolist(), b.tolist())]
    assert sorted(got) == [(a, b) for a in range(200) for b in range(a + 1, 200) if group[a] == group[b] and label[a] != label[b]]
    assert not list(N.cross_pairs(group[:0], label[:0]))
