"""Page extraction, WARC, top-k, classifiers, decontamination and pieces: odd inputs, round trips, brute force."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import _common as C
from corpusloom.llm import decontaminate, quality, sentencepiece, topk, toxicity, warc

DOCS = "doc_id long, text string, y int, score double, key string"


def test_warc_round_trip(spark, tmp_path):
    evil = "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    rows = [(1, "http://a/", "<p>é</p>", 0), (2, "http://b/\r\nX: y", "<p>é</p>", 0), (3, None, None, 0), (4, "u", "", 0), (5, "e", evil, 0), (6, "e", evil + "x", 0), (None, "n", "null id", 0)]
    far = "WARC/1.0\r\nContent-Length: 999999999999\r\n\r\n" * 2 + evil
    rows += [(7, "f", far, 0), (8, "g", "WARC/1.0\r\n", 0), (9, "h", "\r\n\r\nWARC/1.0\r\n\r\n\r\n", 0), (10, "i", "WARC/1.0\r\nWARC/1.0\r\nWARC/1.0", 0), (11, "j", "WARC/1.0", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    for n, (least, kind) in enumerate([("128MB", "gzip"), ("128MB", "none"), ("171b", "none"), ("700b", "none")]):
        path = f"file://{tmp_path}/w{n}"
        warc.write(pages.repartition(2), path, compression=kind)
        spark.conf.set("spark.sql.files.maxPartitionBytes", least)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            assert warc.pieces(spark, path).select("archive", "block").distinct().count() >= (5 if least == "171b" else 1)
            check_warc(rows, warc.read(spark, path).collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    warc.write(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").count() == 0


def check_warc(rows, read):
    got = {r.page_id: r for r in read}
    assert len(read) == len(got) == len(rows)
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        assert got[i].payload_bytes == len(raw)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert (got[1].record_type, got[1].refers_to) == ("revisit", 2) and (got[2].record_type, got[2].refers_to) == ("response", None)
    assert got[3].refers_to == 4 and got[5].record_type == "response" and got[None].record_type == "response"
    assert all(r.digest_ok for r in got.values() if r.record_type == "response")


def test_pointer_jumping_keeps_the_chain_only():
    at, after = np.array([0, 10, 15, 30, 44]), np.array([10, 30, 44, 50, 60])
    jump, leaves = warc.jumps(at, after, np.ones(5, bool))
    assert jump.tolist() == [1, 3, 4, 3, 4] and leaves.tolist() == [False, False, False, True, True]
    assert warc.reachable(jump, 0).tolist() == [True, True, False, True, False]
    assert warc.ends_of(jump).tolist() == [3, 3, 4, 3, 4]
    assert warc.jumps(at, after, np.array([True, True, True, False, True]))[0].tolist() == [1, 1, 4, 3, 4]


def test_topk_against_brute_force(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) for _ in range(20)], 1) for i in range(300)]
    rows += [(400, rows[50][1], 1), (401, rows[50][1], 1), (450, None, 0), (500, [1.0, None] + [0.0] * 18, 0), (550, [math.nan] * 20, 0), (600, [math.inf] * 20, 0), (None, rows[3][1], 0), (650, [1.0, 2.0], 0), rows[7]]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int").repartition(5)).collect()
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in fine:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))[:5]
            want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    assert sorted(tuple(x) for x in got) == sorted(want)
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_maximal_segments():
    r = random.Random(4)
    for _ in range(200):
        n = r.randrange(1, 30)
        s = [r.choice((2.0, 1.0, 0.0, 0.0, 0.0)) for _ in range(n)]
        at = np.array([i for i in range(n) if s[i]], np.int64)
        got = toxicity.maximal_segments(at, np.array([s[i] for i in at]), 0.7)
        full = [x if x else -0.7 for x in s]

        def maximal(a, b):  # by definition: the best run, then the best to its left and right
            best = max(((sum(full[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
            return [] if best[0] <= 0 else maximal(a, best[2]) + [best[0]] + maximal(best[3], b)

        assert np.allclose(sorted(x for *_, x in got), sorted(maximal(0, n)))


def labelled(bad, toxic):
    r = random.Random(9)
    w = lambda: "".join(r.choice(["tha", "on", "re", "it", "sh"]) for _ in range(r.randrange(1, 4)))
    docs, labels = [], []
    for i in range(600):
        t = [w() for _ in range(r.randrange(5, 60))]
        y = i % 3 == 0
        if y:
            t = bad(r, t)
        docs.append((i, " ".join(t), 0, 0.0, ""))
        labels.append((i, int(y == toxic), int(y == toxic)))
    docs += [(9000, None, 0, 0.0, ""), (9001, "", 0, 0.0, ""), (None, "tha on", 0, 0.0, ""), docs[0], (9002, "wordless " * 30000, 0, 0.0, "")]
    return docs, labels + [(None, 1, 1), (3, None, None), labels[4]]


def insert(r, t):
    return t[:3] + [r.choice(("idiot", "scum,")), *t[3:]]


@pytest.mark.parametrize("module, toxic, bad", [(toxicity, True, insert), (quality, False, lambda r, t: [x.upper() + "!!" for x in t])])
def test_classifiers(spark, module, toxic, bad):
    docs, labels = labelled(bad, toxic)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = module.score(d, module.fit(d, lab)).collect()
    assert len(got) == len(docs)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 90 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert module.score(d, module.fit(d, none)).count() == len(docs)
    assert module.score(d.limit(0), module.fit(d.limit(0), lab)).count() == 0


def test_decontamination(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 8)))
    items = [(i, " ".join(word() for _ in range(r.randrange(12, 40))) + ". The answer is " + word() + ".", "t") for i in range(60)]
    docs = [(i, " ".join(word() for _ in range(r.randrange(0, 400))), 0, 0.0, "") for i in range(80)]
    for i in range(0, 80, 4):
        docs[i] = (i, docs[i][1] + "\n" + items[i % 60][1].upper().replace(" ", "  ") + " " + " ".join(word() for _ in range(90)), 0, 0.0, "")
    docs += [(900, None, 0, 0.0, ""), (901, "", 0, 0.0, ""), (902, items[5][1].split(".")[0], 0, 0.0, ""), (None, items[1][1], 0, 0.0, "")]
    bench = spark.createDataFrame(items + [(700, None, ""), (701, " ", ""), (None, "x y z", "")], "item_id long, text string, doc_id string")
    d = spark.createDataFrame(docs, DOCS)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, bench).collect()}
    assert got == {(i, i % 60) for i in range(0, 80, 4)}
    kept = decontaminate.clean(d, bench)
    assert kept.columns == d.columns and kept.count() == len(docs) - 21
    assert decontaminate.contaminated(d, bench.limit(0)).count() == 0


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    r = random.Random(16)
    vocabulary = [f"w{i}x" for i in range(60)] + [f"rare{i}" for i in range(400)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(8, 40))) + ". The answer is " + r.choice(vocabulary) + ".") for i in range(50)]
    cut = [" ".join(w for w in t.split(" ") if r.random() > 0.12) for _, t in items]
    d = spark.createDataFrame([(i, t + " " + " ".join(r.choice(vocabulary) for _ in range(60))) for i, t in enumerate(cut)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = []
    for most in (4096, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", most)
        found.append(sorted((x.doc_id, x.item_id, round(x.score, 9)) for x in decontaminate.contaminated(d, bench).collect()))
    assert found[0] == found[1] and len(found[0]) > 10


def plain_contaminated(docs, bench):
    """Every window of every text against every item, by the formulas."""
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    items = {i: words(t) for i, t in bench}
    df = collections.Counter(w for ws in items.values() for w in set(ws))
    mean = sum(map(len, items.values())) / len(items)
    out = {}
    for i, text in bench:
        ws, n = items[i], len(items[i])
        idf = {w: math.log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5)) for w in ws}
        weight = {w: idf[w] * ws.count(w) * (decontaminate.K1 + 1) / (ws.count(w) + decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * n / mean)) for w in ws}
        total = sum(weight.values())
        step = 1
        while step < 2 * n:
            step *= 2
        cut = len(words(text[: [m.end() for m in re.finditer(r"[.!?](?=\s)", text)][-1]]))
        grams = lambda seq, k: {tuple(seq[a : a + k]) for a in range(len(seq) - k + 1)}
        for d, t in docs:
            have = words(t)
            for a in range(0, max(1, len(have)), step):
                window = have[a : a + 2 * step]
                score = sum(weight[w] for w in set(window) & set(weight)) / total
                if score < decontaminate.THRESHOLD - 1e-9:
                    continue
                share = []
                for part in (ws[:cut], ws[cut:]):
                    k = min(len(part), decontaminate.NGRAM)
                    own = grams(part, k)
                    share.append(len(own & grams(window, k)) / len(own))
                if share[0] >= decontaminate.QUESTION and share[1] >= decontaminate.ANSWER:
                    out[d, i] = max(out.get((d, i), 0), score)
    return {k: round(v, 6) for k, v in out.items()}


def test_decontamination_against_every_window(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randrange(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, text(r.randrange(8, 40)) + ". " + text(r.randrange(4, 12)) + ".") for i in range(30)]
    docs = []
    for d in range(120):
        have = text(r.randrange(0, 300)).split()
        for _ in range(r.randrange(0, 3)):
            own = r.choice(bench)[1].split()
            for _ in range(r.randrange(0, 12)):
                own[r.randrange(len(own))] = word()
            for _ in range(r.randrange(0, 3)):
                own.insert(r.randrange(len(own)), text(r.randrange(1, 20)))
            have.insert(r.randrange(len(have) + 1), " ".join(own))
        docs.append((d, " ".join(have)))
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = lambda rows: spark.createDataFrame(rows, "item_id long, text string")
    got = {(x.doc_id, x.item_id): round(x.score, 6) for x in decontaminate.contaminated(frame(docs), items(bench)).collect()}
    want = plain_contaminated(docs, bench)
    assert got == want
    assert len(want) > 20


def test_a_long_item_changes_no_other_items_results(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(30)]
    parts = [" ".join(item[k : k + 10]) for k in (0, 10, 20)]
    apart = (" " + " ".join(word() for _ in range(300)) + " ").join(parts)
    docs = spark.createDataFrame([(1, apart), (2, "so " + " ".join(item) + " it is")], "doc_id long, text string")
    short = [(1, " ".join(item))]
    for bench in (short, [*short, (2, " ".join(word() for _ in range(3000)))]):
        assert [(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()] == [(2, 1)]


def test_block_max_wand_finds_all_above_the_threshold():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(80)]
    index = decontaminate.Index.of([(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(5, 40)))) for i in range(300)])
    for _ in range(40):
        terms = np.array(sorted(r.sample(range(len(index.term)), r.randrange(1, 60))))
        total = np.zeros(len(index.ids))
        for t in terms:
            items, impact, _ = index.lists[t]
            total[items] += impact
        for threshold in (0.1, 0.4, 0.7):
            assert sorted(i for i, _ in index.retrieve(terms, threshold)) == np.flatnonzero(total >= threshold - 1e-9).tolist()


TEXTS = ["", "a", " a  b\tc\n d ", "▁mark ▁", "naïve Ünïcode 漢字 🙂", "x" * 3000, "the the the", "\n\n\t", "é" * 100, "word " * 4000]


def test_pieces_round_trip(spark):
    rows = [(i, t, 0, 0.0, "") for i, t in enumerate(TEXTS)] + [(None, "null id", 0, 0.0, ""), (99, None, 0, 0.0, ""), (6, "the the the", 0, 0.0, "")]
    d = spark.createDataFrame(rows, DOCS)
    e = sentencepiece.encode(d)
    got = e.collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_pieces == len(r.pieces) for r in got)
    back = {r.doc_id: r.text for r in sentencepiece.decode(e).collect()}
    assert all(back[i] == (t or "") for i, t, *_ in rows)
    again = {r.doc_id: r.pieces for r in sentencepiece.encode(d.repartition(7)).collect()}
    assert again == {r.doc_id: r.pieces for r in got}
    assert sentencepiece.encode(d.limit(0)).count() == 0


def test_sampling_follows_the_lattice():
    v = sentencepiece.vocabulary()
    unit = b" there"
    piece = {}
    for size in v.lengths:
        for at in range(len(unit) - size + 1):
            sub = unit[at : at + size]
            for i in np.flatnonzero(v.sizes == size):
                if i > 258 and v.text[v.place[i] : v.place[i] + size].tobytes() == sub:
                    piece[sub] = int(i)

    def every(s):
        if not s:
            return [((), 1.0)]
        return [((piece[s[:k]], *rest), v.weight[piece[s[:k]]] * w) for k in range(1, len(s) + 1) if s[:k] in piece for rest, w in every(s[k:])]

    ways = dict(every(unit))
    n = 20000
    data = np.frombuffer(unit[1:] * n, np.uint8)
    ids, off = sentencepiece.sample_pieces(v, data, np.arange(n + 1) * (len(unit) - 1), np.arange(n, dtype=np.uint64) * np.uint64(7919))
    seen = {}
    for a, b in zip(off[:-1], off[1:]):
        k = tuple(ids[a:b].tolist())
        seen[k] = seen.get(k, 0) + 1
    total = sum(ways.values())
    assert set(seen) <= set(ways)
    assert all(abs(seen.get(k, 0) / n - w / total) < 0.02 for k, w in ways.items())


def test_units_of_any_length_have_one_lattice(monkeypatch):
    """Long units go by logarithms: the same pieces as without, and no edge at 64 bytes."""
    v = sentencepiece.vocabulary()
    r = random.Random(2)
    texts = ["the there then 漢字かな交じり文 naïve🙂 http://example.org/a/b?c=d", "", " x", "".join(r.choice("abcdeé漢") for _ in range(60)), "word " * 30]
    data, off = C.text_bytes(pa.array(texts))
    seed = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919)
    want = sentencepiece.sample_pieces(v, data, off, seed)
    monkeypatch.setattr(sentencepiece, "UNIT_BYTES", 0)
    got = sentencepiece.sample_pieces(v, data, off, seed)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
    monkeypatch.undo()
    long = ("there" * 40).encode()  # 200 bytes in one unit
    n = 300
    ids, at = sentencepiece.sample_pieces(v, np.frombuffer(long * n, np.uint8), np.arange(n + 1) * len(long), np.arange(n, dtype=np.uint64))
    across = 0
    for a, b in zip(at[:-1], at[1:]):
        end = np.cumsum(v.sizes[ids[a:b]])
        assert end[-1] == len(long) + 1
        across += 64 not in end
    assert across > 0
    text = "漢字" * 20000
    ids, at = sentencepiece.sample_pieces(v, *C.text_bytes(pa.array([text])), seed[:1])
    assert sentencepiece.join_pieces(v, ids, at)[0].tobytes().decode() == text
