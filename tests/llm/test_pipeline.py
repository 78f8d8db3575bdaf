"""The pipeline's stages, and run(), against plain versions; odd rows and columns of any name."""

import random

import corpus_pipeline as P
import pytest

from corpusloom.llm import near_dedup, sentencepiece

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_bytes long, kept_sha256 string, `a b` int, `c.d` int, carried_0 string, label long, node long, score double, y int"


NO_ID = "the row without an id"


def word(r):
    return "".join(r.choice(["tha", "on", "re", "it", "sh", "la", "mo", "ne"]) for _ in range(r.randrange(1, 5)))


def corpus():
    r = random.Random(12)
    text = lambda n: " ".join(word(r) for _ in range(n))
    docs, toxic = {}, {}
    for i in range(700):
        t = text(r.randrange(15, 90)).split(" ")
        toxic[i] = int(i % 7 == 0)
        for _ in range(4 * toxic[i]):
            t.insert(r.randrange(len(t)), "scumbag" + r.choice(["", "s", "ly"]))
        docs[i] = " ".join(t)
    items = {i: f"{text(20)}. The answer is {word(r)}{word(r)} {word(r)}." for i in range(6)}
    copies = {1000 + k: docs[302 + k] for k in range(5)} | {1010 + k: docs[330] + " " + word(r) for k in range(3)}
    passage = text(40)
    shares = {1100 + k: f"{text(30)} {passage} {text(30)}" for k in range(4)}
    leaks = {1200 + k: f"{text(10)} {items[k]} {text(10)}" for k in range(3)}
    odd = {5000: "", 5001: "é" * 30, 5002: "a", 5003: text(9000)}
    return docs | copies | shares | leaks | odd, toxic, items, passage


def rows_of(docs):
    return [(i, t, "en", "s", len(t), "k", 1, "x", 2, 3, "c", 4, 5, 0.5, 1) for i, t in docs.items()]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    docs, toxic, items, passage = corpus()
    at = f"file://{tmp_path_factory.mktemp('pipe')}"
    rows = rows_of(docs) + [(None, NO_ID, *(None,) * 13), (None, None, *(None,) * 13)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1 - y, y) for i, y in toxic.items()] + [(None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(items.items()) + [(99, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, docs, toxic, items, passage


def plain_cut(docs, window=50):
    """Each text without the bytes of 50-byte strings that a smaller doc_id has, and without characters cut in part."""
    first = {}
    for i in sorted(docs):
        b = docs[i].encode()
        for p in range(len(b) - window + 1):
            first.setdefault(b[p : p + window], i)
    out = {}
    for i, t in docs.items():
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if first[b[p : p + window]] < i:
                gone[p : p + window] = b"\x01" * window
        out[i] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def test_each_stage_and_the_whole(spark, data):
    at, docs, toxic, items, passage = data
    now = spark.read.parquet(f"{at}/documents.parquet")
    before = dict(docs)
    for name, stage in P.STAGES:
        out = stage(spark, now, at)
        if name == "sentencepiece":
            assert out.columns[0] == "doc_id" and out.where("NOT lossless").isEmpty()
            back = {r.doc_id: r.text for r in sentencepiece.decode(out).collect()}
            assert back == before | {None: NO_ID}
            break
        assert out.columns == now.columns and out.dtypes == now.dtypes
        got = out.collect()
        after = {r.doc_id: r.text for r in got}
        assert len(after) == len(got) - (name == "toxicity")  # a null text is a copy of an empty one
        if name == "toxicity":
            assert sum(i not in after for i, y in toxic.items() if y) >= 0.9 * sum(toxic.values())
            assert sum(i not in after for i in docs if not toxic.get(i)) <= 0.01 * len(docs)
            assert None in after and 5000 in after
        elif name == "near_dedup":
            gone = set(before) - set(after)
            assert {1000 + k for k in range(5)} | {1010, 1011, 1012} == gone
        elif name == "suffix_dedup":
            assert {i: t for i, t in after.items() if i is not None} == plain_cut({i: t for i, t in before.items() if i is not None})
            assert sum(passage in t for t in after.values()) == 1 and after[None] == NO_ID
            assert all(r.n_chars == len(r.text) and (r["a b"], r["c.d"], r.kept, r.carried_0) == ((2, 3, "k", "c") if r.doc_id is not None else (None,) * 4) for r in got)
        elif name == "decontamination":
            assert set(before) - set(after) == {1200, 1201, 1202}
        before = {i: t for i, t in after.items() if i is not None}
        now = spark.createDataFrame(got, out.schema)
    whole = P.run(spark, at)
    assert {r.doc_id: r.text for r in sentencepiece.decode(whole).collect()} == before | {None: NO_ID}


def test_empty_tables(spark, tmp_path):
    at = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    assert P.run(spark, at).count() == 0


def test_repeated_rows_and_equal_ids(spark):
    rows = [(1, "one two three four five six", 1), (1, "one two three four five six", 1), (1, "another text by the same id here", 1), (None, None, None), (None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    kept = P.drop_near_copies(spark, d, "")
    assert sorted(r.text or "" for r in kept.collect()) == ["", "another text by the same id here", "one two three four five six"]
    cut = P.drop_repeats(spark, d, "")
    assert sorted(r.text for r in cut.collect()) == sorted(t or "" for _, t, _ in rows) and cut.columns == d.columns
    assert near_dedup.classes(d).count() == len(rows)
