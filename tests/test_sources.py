"""Source rules and what reaches the reader, feedback between cycles, samples, links, files that are written whole or not at all."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.operators import frontier, probes
from corpusloom.sources import connectors as C
from corpusloom.sources import files


def lines(folder, source, node, rows, stats=None):
    os.makedirs(folder / source, exist_ok=True)
    (folder / source / f"{node}.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    if stats is not None:
        (folder / source / f"{node}.stats.json").write_text(json.dumps(stats))


def test_rules_reach_the_reader(spark, tmp_path):
    rows = [{"identifier": f"i{i}", "score": i % 3, "year": 1970 + i, "comments": i, "rights": ["public", "Full view", None][i % 3]} for i in range(90)]
    for s in ("stackexchange", "core", "reddit", "hathitrust", "wikipedia"):
        lines(tmp_path, s, "n", rows)
    lines(tmp_path, "core", "old", [{"identifier": "x", "year": 1999}], {"year": 1979})  # its statistics say that it has nothing: it isn't read
    lines(tmp_path, "core", "bad", [{"identifier": "y", "year": 1999}, {"identifier": "z"}], None)
    (tmp_path / "core" / "bad.stats.json").write_text("{")
    got = {s: [r.identifier for r in C.search(spark, str(tmp_path), s).orderBy("node", "rank").collect()] for s in ("stackexchange", "core", "reddit", "hathitrust", "wikipedia")}
    first = [(i, r) for i, r in enumerate(rows[:80])]
    assert got["stackexchange"] == [f"i{i}" for i, r in first if r["score"] >= 1]
    assert got["core"] == ["y", *[f"i{i}" for i, r in first if r["year"] >= 1980]]
    assert got["reddit"] == [f"i{i}" for i, r in first if r["comments"] >= 5 or r["score"] >= 10]
    assert got["hathitrust"] == [f"i{i}" for i, r in first if r["rights"] == "Full view"] and len(got["wikipedia"]) == 80
    reader = C.CandidateReader({"path": str(tmp_path)})
    left = list(reader.pushFilters([C.EqualTo(("source",), "core"), C.GreaterThanOrEqual(("year",), 1980), C.GreaterThan(("score",), 0), C.GreaterThan(("rank",), 1)]))
    assert [f.attribute for f in left] == [("rank",)] and reader.least == {"year": 1980, "score": 1}
    assert [p.node for p in reader.partitions()] == ["bad", "n"]


def test_threads_and_answers(spark):
    posts = spark.createDataFrame([(1, i, i % 2, ("c" * 40) + str(i)) for i in range(70)] + [(1, 99, 5, "short"), (2, 1, 0, "x" * 50)], "thread long, seq long, score long, text string")
    got = {r.thread: r.text.split("\n\n") for r in C.threads(posts, spark.createDataFrame([(1, "body"), (2, "alone")], "thread long, text string")).collect()}
    assert got == {1: ["body", *["c" * 40 + str(i) for i in range(70) if i % 2][:30]], 2: ["alone"]}
    a = spark.createDataFrame([(1, 1, 0, "a"), (1, 2, 5, "b"), (1, 3, 5, "c"), (1, 4, 1, "d"), (1, 5, 2, "e")], "question long, seq long, score long, text string")
    assert [r.text for r in C.best_answers(a).orderBy("place").collect()] == ["b", "c", "e"]


def test_a_cycle_learns_from_the_one_before(spark):
    found = spark.createDataFrame([("s", "n", i, f"i{i}", i == 2) for i in range(1, 11)], "source string, node string, rank int, identifier string, saved boolean")
    none = spark.createDataFrame([], "identifier string, high_value boolean")
    first = frontier.cycle(found, none, none)
    assert sorted(r["rank"] for r in first.collect()) == [1, 2, 3, 4, 5]
    known = frontier.known_sources(first.union(first))
    assert [r.identifier for r in known.where("high_value").collect()] == ["i2"]
    second = frontier.cycle(found, known, spark.createDataFrame([("i1",), ("i1",)], "identifier string"))
    assert sorted(r["rank"] for r in second.collect()) == [2, 3, 4, 5, 6, 7, 8]


@pytest.mark.parametrize("parts", [1, 7])
def test_the_sample_is_the_same_however_claims_are_spread(spark, parts):
    claims = spark.createDataFrame([(i, i % 9 == 0) for i in range(100)], "claim_id long, specific boolean").repartition(parts)
    got = [(r.claim_id, r.turn) for r in probes.specifics_first(claims, 30, 3).collect()]
    assert len(got) == 30 and sorted(i for i, t in got if t == 0) == list(range(0, 100, 9))
    assert got == [(r.claim_id, r.turn) for r in probes.specifics_first(claims.repartition(3, "specific"), 30, 3).collect()]
    assert got != [(r.claim_id, r.turn) for r in probes.specifics_first(claims, 30, 4).collect()]


def test_small_rules(spark):
    df = spark.createDataFrame([("cut the edge of it*~ now", [["awl", "it"], ["awl", None, "bench"]])], "t string, tools array<array<string>>")
    r = df.select(R.skill_area(F.col("t")).alias("a"), R.video_url(F.col("t")).alias("u"), R.used_tools(F.col("tools")).alias("k"), R.run_id(F.lit("x"), F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("i")).first()
    assert (r.a, r.u.split("=")[1], r.k, r.i) == ("cut the edge of", "cut+the+edge+of+it%2A~+now", ["awl", "bench"], "x_20240102-030405")
    urls = ["https://a.org/x", "http://web.b.com", "https://netflix.com/", "http://c.xyz/d", "https://youtu.be/1"]
    got = R.worth_fetching(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert sorted((r.url, r.domain) for r in got) == [("http://web.b.com", "eb.b.com"), ("https://a.org/x", "a.org")]


def names(folder):
    return {n: open(folder / n).read() for n in sorted(os.listdir(folder))}


def test_files_come_whole_or_not_at_all(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "name string, content string").repartition(3)
    files.save(rows(("a.md", "one"), ("b.md", "two")), str(tmp_path))
    assert names(tmp_path) == {"a.md": "one", "b.md": "two"}
    files.save(rows(("a.md", "new"), ("c.md", "three")), f"file://{tmp_path}", keep=True)
    assert names(tmp_path) == {"a.md": "one", "b.md": "two", "c.md": "three"}
    bad = F.when(F.col("name") == "b.md", F.raise_error(F.lit("lost"))).otherwise(F.col("content"))
    with pytest.raises(Exception, match="lost"):
        files.save(rows(("a.md", "new"), ("b.md", "new"), ("c.md", "new")).withColumn("content", bad.cast("string")), str(tmp_path))
    with pytest.raises(Exception, match="not the name"):
        files.save(rows(("../a.md", "new")), str(tmp_path))
    assert names(tmp_path) == {"a.md": "one", "b.md": "two", "c.md": "three"}
    files.save(rows(("a.md", None), ("b.md", "x")), str(tmp_path), dry_run=True)
    assert len(names(tmp_path)) == 3
    files.save(rows(("a.md", None), ("gone.md", None), ("b.md", "x")), str(tmp_path))
    assert names(tmp_path) == {"b.md": "x", "c.md": "three"}


def test_reports(spark, tmp_path):
    findings = spark.createDataFrame([("Contradictions", "8 oz, 9 oz"), ("Headings twice", "Tools"), ("Headings twice", "Edges")], "kind string, line string")
    files.save(files.coherence(findings, "belts"), str(tmp_path))
    assert names(tmp_path) == {"coherence.md": "# Coherence of belts\n\n## Contradictions\n\n- 8 oz, 9 oz\n\n## Headings twice\n\n- Edges\n- Tools"}
    files.save(files.coherence(findings.limit(0), "belts"), str(tmp_path))  # a cycle without findings leaves the old file
    assert len(names(tmp_path)) == 1
    plans = spark.createDataFrame([("belts", 2, "b"), ("belts", 1, "a"), ("bags", 1, "c")], "topic string, week int, task string")
    files.save(files.states(plans, "topic", "week", "task"), str(tmp_path))
    assert json.loads(names(tmp_path)["belts.json"]) == [{"week": 1, "task": "a"}, {"week": 2, "task": "b"}]
    vault = spark.createDataFrame([("a.txt", 0, 10), ("b.txt", 3, 20), ("c.txt", 0, 30)], "name string, hits int, bytes long")
    used = spark.createDataFrame([("c.txt",), ("c.txt",)], "name string")
    assert {r.name: (r.content, r.junk) for r in files.cleanup(vault, used).collect()} == {"a.txt": (None, True), "b.txt": (None, False), "c.txt": (None, False)}
    assert tuple(files.duplicates(vault, used).first()) == (1, 2, 30, 30)
    assert tuple(files.duplicates(vault.limit(0), used).first()) == (0, 0, 0, 0)
