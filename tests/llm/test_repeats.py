"""Suffix-array and seed-and-extend deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from corpusloom.llm import seed_extend, suffix_dedup

SCHEMA = "doc_id long, text string, extra int, kind int, blob string"


def fixture(seed=1, n=60):
    r = random.Random(seed)
    word = ["the", "of", "thé", "onre", "aau", "ti", "x", "ingre", "é"]
    passage = [" ".join(r.choice(word) + str(r.randrange(99)) for _ in range(r.randrange(20, 90))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [r.choice(passage)[r.randrange(40) :] if r.random() < 0.5 else " ".join(r.choice(word) for _ in range(r.randrange(1, 60))) for _ in range(r.randrange(1, 5))]
        rows.append((i * 3 % 101, r.choice(["\n", " ", "\t"]).join(parts), i, 1, "b"))
    rows += [(500, None, 0, 0, ""), (501, "", 0, 0, ""), (None, rows[3][1], 0, 0, ""), (502, "Orre " * 60, 0, 0, ""), (503, "Orre " * 70, 0, 0, ""), (rows[5][0], rows[9][1], 0, 0, ""), rows[7], (504, "tiny", 0, 0, "")]
    return rows


def brute(rows, window, by_word):
    least = {}
    seqs = []
    for d, t, *_ in rows:
        s = re.findall(r"[^\x20\x09-\x0D]+", t or "") if by_word else (t or "").encode()
        seqs.append(s)
        for i in range(len(s) - window + 1):
            w = tuple(s[i : i + window])
            k = float("inf") if d is None else d
            least[w] = min(least.get(w, float("inf")), k)
    out = []
    for (d, *_), s in zip(rows, seqs):
        k = float("inf") if d is None else d
        m = np.zeros(len(s), bool)
        for i in range(len(s) - window + 1):
            if least[tuple(s[i : i + window])] < k:
                m[i : i + window] = True
        kept = [x for x, gone in zip(s, m) if not gone]
        body = " ".join(kept).encode() if by_word else bytes(kept)
        out.append((-1 if d is None else d, len(s), int(m.sum()), int((m & ~np.r_[False, m[:-1]]).sum()) if len(m) else 0, hashlib.sha256(body).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [50, 7])
def test_suffix_dedup(spark, window):
    rows = fixture()
    got = suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), window).drop("kept").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, window, False)


@pytest.mark.parametrize("window", [50, 5])
def test_seed_extend(spark, window):
    rows = fixture(2)
    got = seed_extend.dedup(spark.createDataFrame(rows, SCHEMA).repartition(3), window).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == [(d, n, m, h) for d, n, m, _, h in brute(rows, window, True)]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.dedup(empty).count() == 0
    assert seed_extend.dedup(empty).count() == 0


def test_deep_shallow_orders_suffixes():
    r = random.Random(3)
    text = np.frombuffer(bytes(r.choice(b"ab") for _ in range(600)) + b"a" * 200, np.uint8)
    at = np.arange(700)
    order, klass = suffix_dedup.deep_shallow(text, at, 50, 16)
    got = [text[p : p + 50].tobytes() for p in at[order]]
    assert got == sorted(got)
    assert [a == b for a, b in zip(got, got[1:])] == list(klass[1:] == klass[:-1])
