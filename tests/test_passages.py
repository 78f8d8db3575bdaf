"""Passages through the stored index against a plain search; slices, repeats and drift of chapters."""

import math
import random
import re

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import sections as S
from corpusloom.operators import vault_index as V

LEXICON = ["cut edge", "awl", "edge", "oil can"]


def heads(text):
    out = []
    for line in text.split("\n"):
        line = line.strip()
        if re.match(r"#{1,4}\s+\S", line):
            out.append(line.lstrip("#").strip())
        elif re.match(r"={2,}\s*[^\s=]", line):
            out.append(line.replace("=", "").strip())
    return out[:25]


def plain(files, chapters, tags, budget):
    """Chapter by chapter and file by file, with every text read."""
    out, ranks = [], []
    for chapter, title, topics in chapters:
        terms = {w for t in topics for w in t.lower().split()} | {w for w in title.lower().split() if len(w) > 3}
        terms |= {t for t in LEXICON if any(w in t for w in terms)}
        words = {w for w in title.lower().replace(":", " ").split() if len(w) > 3} | {t.lower().split()[0] for t in topics if t.split()}
        scored = []
        for f, text in files:
            low = text.lower()
            raw = 3 * sum(t in low for t in terms & set(LEXICON)) + 2 * sum(any(t in h.lower() for t in terms) for h in heads(text)) + min(10, sum(t in low for t in terms))
            if any(w in slot or slot.split("-")[0] in w for slot in tags.get(f, ()) for w in words):
                raw = int(raw * 1.5) + 2
            if raw:
                scored.append((-round(raw / math.sqrt(max(1, len(text.split()))), 9), f, raw))
        scored.sort()
        left, got = budget, []
        for rank, (s, f, raw) in enumerate([x for x in scored if -x[0] >= 0.25 * -scored[0][0]][:15], 1):
            ranks.append((chapter, rank, f, raw))
            if left <= 0:
                continue
            parts = [p.strip() for p in re.split(r"\n{2,}|(?=\n#{1,4}\s)", dict(files)[f])]
            parts = sorted(((-sum(t in p.lower() for t in terms), i, p) for i, p in enumerate(parts) if len(p) >= V.LEAST))
            taken, used = [], 0
            for n, _, p in parts:
                if n < 0 and used < left:
                    taken.append(p[: left - used])
                    used += len(taken[-1])
            if taken:
                got.append((chapter, rank, f, len(taken), "\n\n".join(taken)))
                left -= len(got[-1][4])
        out += got or [(chapter, i, f, 1, text[: V.FALLBACK_CHARS]) for i, (_, f, text) in enumerate(sorted((-len(t.split()), f, t) for f, t in files)[:3], 1)]
    return sorted(out), sorted(ranks)


def test_passages_are_those_of_a_plain_search(spark, tmp_path):
    r = random.Random(4)
    words = ["cut", "edge", "edges", "awl", "bevelled", "oil", "can", "of", "a", "Leather", "stitch", "é", "hide", "cutting"]
    line = lambda: " ".join(r.choice(words) for _ in range(r.randrange(2, 30)))
    files = [(i, "".join(r.choice(["", "", "# ", "## ", "== "]) + line() + r.choice(["\n", "\n\n", "\n"]) for _ in range(r.randrange(0, 12)))) for i in range(60)]
    chapters = [(1, "The cut edge", ["awl of"]), (2, "Nothing: here", ["zebra"]), (3, "Leather", ["a", "OIL can"]), (4, "", ["stitch", ""]), (5, "Bevelled things", [])]
    tags = {7: ["cut-thing"], 9: ["zebra-x", "none"], 11: ["bevel"]}
    for budget in (700, 20_000):
        index = V.Index(spark, f"file://{tmp_path}/{budget}", 4).build(spark.createDataFrame([*files, (99, None)], "file long, text string"))
        c = spark.createDataFrame(chapters, "chapter long, title string, topics array<string>")
        classes = spark.createDataFrame([(f, s) for f, ss in tags.items() for s in ss], "file long, slot string")
        want, ranks = plain([*files, (99, "")], chapters, tags, budget)
        assert sorted((x.chapter, x["rank"], x.file, x.raw) for x in V.ranked(index, c, LEXICON, classes).collect()) == ranks
        assert sorted(map(tuple, V.passages(index, c, LEXICON, classes, budget).collect())) == want


def test_texts_are_made_once_and_short_parts_read_each_token_once(spark, tmp_path):
    made, read = spark.sparkContext.accumulator(0), []

    def rows(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    class Watched(V.Index):
        def table(self, name, bucket=None):
            read.append((name, bucket is None))
            return super().table(name, bucket)

    files = spark.createDataFrame([(i, f"an awl{i} of hide") for i in range(40)], "file long, text string").mapInArrow(rows, "file long, text string")
    index = Watched(spark, f"file://{tmp_path}/index", 4).build(files)
    assert made.value == 40
    assert index.table("tokens").count() == index.table("grams").select("token").distinct().count() == 43
    read.clear()
    got = index.matches(spark.createDataFrame([("of",), ("w",), ("l7",), ("hid",), ("a b",)], "term string")).collect()
    assert ("grams", True) not in read and ("tokens", True) in read
    want = [(t, i, -1) for i in range(40) for t in ("of", "w", "hid")] + [("l7", 7, -1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_headings(spark):
    text = "# A \nb\n#no\n  ## 1. C c\n=== D = d ===\n##### e\n==\n"
    assert spark.createDataFrame([(text,)], "t string").select(X.headings(F.col("t"))).first()[0] == ["A", "1. C c", "D  d"]


def test_a_title_gets_its_slice(spark):
    book = "intro\n## 1. One\na\n### sub\nb\n##  TWO \nc\n## Other\nd\n## One\ne\n## 3) 4. Four\nf"
    titles = [(1, 1, "One"), (1, 2, "two"), (1, 3, "Missing"), (1, 4, "4. Four"), (1, 5, "ONE"), (2, 1, "One")]
    got = {(r.book, r.n): r.content for r in S.slices(spark.createDataFrame([(1, book), (2, None)], "book long, text string"), spark.createDataFrame(titles, "book long, n long, title string")).collect()}
    assert got == {(1, 1): "", (1, 5): "## 1. One\na\n### sub\nb", (1, 2): "##  TWO \nc\n## Other\nd\n## One\ne", (1, 4): "## 3) 4. Four\nf"}
    c = spark.createDataFrame([("## Learning Outcomes\nTry this: x\n",), ("x " * 500 + "## review questions",)], "content string")
    assert [(r.words, r.thin, r.outcomes, r.try_this, r.questions) for r in S.checks(c).collect()] == [(6, True, True, True, False), (503, False, False, False, True)]


def test_repeated_sections_go(spark):
    rows = [("b", 1, "start\n## Tools\nx\n## Summary\ns\n## 2. tools\ny\n\n\n\n### Deep\nz"), ("b", 2, "## Summary\nt\n### deep\nu\n## New\nv"), ("b", 3, "plain"), ("c", 1, "## tools\nw"), ("c", 2, None), ("c", 3, "")]
    got = {(r.book, r.chapter): (r.text, r.trimmed) for r in S.without_repeats(spark.createDataFrame(rows, "book string, chapter long, text string")).collect()}
    assert got == {("b", 1): ("start\n## Tools\nx\n## Summary\ns\n### Deep\nz", 1), ("b", 2): ("## Summary\nt\n## New\nv", 1), ("b", 3): ("plain", 0), ("c", 1): ("## tools\nw", 0), ("c", 2): ("", 0), ("c", 3): ("", 0)}


def test_a_chapter_off_its_topic_becomes_a_stub(spark):
    assert S.chapter_roots("leatherworking_craft") == ["leather", "leatherwork", "leatherworking", "leatherworking craft"]
    rows = [(1, "Leather is cut. " * 3, ["a"]), (2, "Wood is cut. " * 200, ["a", "b"]), (3, None, ["c"])]
    got = {r.id: r for r in S.on_topic(spark.createDataFrame(rows, "id long, text string, topics array<string>"), "leatherworking").collect()}
    assert (got[1].drifted, got[1].missing, got[1].text) == (False, [], rows[0][1])
    assert got[2].drifted and got[2].missing == ["a", "b"] and got[2].text.endswith("topics:** a, b") and got[3].drifted


def test_tool_passages(spark):
    para = lambda n, name: ("x" * n + f" {name} ").ljust(n + 20, "y")
    rows = [(2, para(700, "AWL")), (1, "short awl\n\n" + para(100, "awl") + "\n\n" + para(90, "none")), (3, None), *[(10 + i, para(900, "awl")) for i in range(20)], *[(50 + i, para(100, "Edge")) for i in range(20)]]
    got = {}
    for r in V.tool_passages(spark.createDataFrame(rows, "file long, text string").repartition(4), ["awl", "edge", "saw"]).orderBy("tool", "place").collect():
        got.setdefault(r.tool, []).append((r.place, r.file, r.part, len(r.snippet)))
    assert got["awl"][:3] == [(1, 1, 1, 120), (2, 2, 0, 600), (3, 10, 0, 600)] and len(got["awl"]) == 11 and sum(x[3] for x in got["awl"][:-1]) < 6000
    assert [x[1] for x in got["edge"]] == list(range(50, 62)) and "saw" not in got
    assert V.tool_passages(spark.createDataFrame(rows, "file long, text string"), []).count() == 0
