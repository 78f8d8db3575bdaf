"""Text functions and fingerprints: pinned cases, and plain Python for comparison."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import simhash
from corpusloom.sources.scratch import stored


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).head().x


@pytest.mark.parametrize("text, ids", [("a [C7].", [7]), ("[C1, C2]", [1, 2]), ("[C1 C2]", [1, 2]), ("[C1] [C11] x [C40]", [1, 11, 40]), ("none", []), ("[Note] [1]", [])])
def test_marker_ids(spark, text, ids):
    assert one(spark, text, X.marker_ids) == ids


def test_strip_markers_is_idempotent(spark):
    once = one(spark, "Cut it [C7] , then  stop [C1, C2].", X.strip_markers)
    assert once == "Cut it, then stop." and one(spark, once, X.strip_markers) == once


@pytest.mark.parametrize("text, want", [("12-14", 13.0), ("2,5", 2.5), ("7", 7.0), ("x", None)])
def test_range_average(spark, text, want):
    assert one(spark, text, X.range_average) == want


@pytest.mark.parametrize("answer, ok", [('{"a": 1}', True), ('<think>no</think>```json\n{"a": [1]}\n```', True), ("so: [1, 2] ok", True), ("nothing", False)])
def test_model_json(spark, answer, ok):
    assert one(spark, answer, lambda c: X.model_json(c).isNotNull()) is ok


@pytest.mark.parametrize("fn, text, want", [(X.topic_slug, "My Topic: a-b!", "My_Topic_a-b"), (X.slugify, "Two Words, yes", "two-words-yes"), (X.domain, "http://web.x.com/a", "eb.x.com"), (X.word_count, " a\tb \n", 2), (X.lemma, "stories", "story"), (X.headings, "# A\nx\n== B ==\n", ["A", "B"])])
def test_scalars(spark, fn, text, want):
    assert one(spark, text, fn) == want


def plain_fingerprint(text):
    v = [0] * 64
    for i in range(len(text) - 5):
        h = zlib.adler32(text[i : i + 6].encode())
        h = (h << 32) | (h ^ 0x55555555)
        v = [n + (1 if h >> b & 1 else -1) for b, n in enumerate(v)]
    return sum(1 << b for b in range(64) if v[b] > 0)


@pytest.mark.parametrize("text", ["", "abc", "abcdef", "naïve Übung 漢字 text, long enough", "xy" * 50])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) % (1 << 64) == plain_fingerprint(text)


def test_pairs_and_greedy_order(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(12)]
    prints = []
    for i in range(150):
        f = r.choice(base)
        for _ in range(r.randrange(0, 5)):
            f ^= 1 << r.randrange(64)
        prints.append((i, r.choice("ab"), r.randrange(9), f - (1 << 64) if f >> 63 else f))
    d = spark.createDataFrame(prints, "doc_id long, topic string, size int, fp long")
    near = lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 4
    want = {(t, min(f, g), max(f, g)) for _, t, _, f in prints for _, u, _, g in prints if t == u and f != g and near(f, g)}
    assert {tuple(x) for x in simhash.near_pairs(d).collect()} == want
    kept = []
    for i, t, c, f in sorted(prints, key=lambda x: (-x[2], x[0])):
        if not any(u == t and near(f, g) for _, u, g in kept):
            kept.append((i, t, f))
    got = simhash.greedy_keep(d, [-F.col("size"), F.col("doc_id")], stored)
    assert sorted(x.doc_id for x in got.collect()) == sorted(i for i, _, _ in kept)
