"""Links, citations, claim verification, probes, records, connectors, reports and the frontier loop."""

import gzip
import json

import pandas as pd
from pyspark.sql import functions as F

from corpusloom.functions import backend as B
from corpusloom.functions import links as L
from corpusloom.functions import records as R
from corpusloom.operators import frontier, probes, verify
from corpusloom.sources import connectors as C
from corpusloom.sources import reports

BOOK = "# Book\n## 1. Saddle Stitching\nUse edge finishing here, edge finishing there.\n## 2. The Edge Finishing Guide\nAfter saddle stitching, [saddle stitching](#x).\n"


def test_chapters_link_to_each_other():
    text, n = L.link_chapters(BOOK)
    assert n == 2
    assert "Use [edge finishing](#the-edge-finishing-guide) here, edge finishing there." in text
    assert "After [saddle stitching](#saddle-stitching), [saddle stitching](#x)." in text
    assert L.link_chapters("## One\nalone") == ("## One\nalone", 0) and L.link_chapters("") == ("", 0)
    assert L.title_phrases("Introduction to the Topic") == [] and L.title_phrases("The Awl") == []


def test_tools_are_cited_once_a_line_and_again_without_change():
    text, n = L.cite_tools("# awl\nAn awl and two awls.\n    awl\nEdge beveler, old [-> Tool Library: awl]", ["awl", "edge beveler"])
    assert n == 2
    assert text.startswith("# awl\nAn [awl][tool:awl] and two awls.\n    awl\n[Edge beveler][tool:edge beveler], old\n\n<!-- tool-refs -->\n[tool:awl]: #tool-awl\n[tool:edge beveler]: #tool-edge-beveler")
    assert L.cite_tools(text, ["awl", "edge beveler"])[0] == text
    assert L.cite_tools("plain", []) == ("plain", 0)


def test_flagged_claims_are_marked_or_dropped():
    text, n = L.mark_flagged("## A\nThe **hide** takes 8 oz of oil. Next.", "A", ["The hide takes 8 oz of oil", "short"])
    assert n == 1 and "oil ⚠. Next" in text
    assert L.mark_flagged("## A\nText", "B", ["The hide takes 8 oz of oil"]) == ("## A\nText", 0)
    text, n = L.mark_flagged("## A\nThe  hide takes 8 oz of oil. Next.\n## B\nThe hide takes 8 oz of oil.", "A", ["The hide takes 8 oz of oil"])
    assert n == 1 and text.count("⚠") == 1 and "oil ⚠. Next" in text
    assert L.drop_flagged("Keep. The hide takes 8 oz of oil at once. Keep too.", ["The hide takes 8 oz"]) == ("Keep. Keep too.", 1)
    assert L.drop_flagged("Keep.", ["tiny"]) == ("Keep.", 0)
    text, n = L.annotate("One awl is here. Another.", [["awl", "zz"], []])
    assert n == 1 and text.startswith("One awl is here. [⚠ UNVERIFIED")


def plain_verify(claims, records, files, low):
    out = {}
    for cid, text, words in claims:
        c = verify.Claims([(cid, text, words)])
        need, found = max(1, len(words) // 2), []
        for s in dict.fromkeys(s for s, _ in records):
            if any(sum(w in t.lower() for w in words) >= need and verify._same_number(c, 0, [], t) for r, t in records if r == s):
                found.append(s)
        for s, t in files:
            at = [(w, t.lower().find(w)) for w in words if w in t.lower()]
            if len(at) >= need and verify._near(c, 0, at, t):
                found.append(s)
        high = sum(s not in low for s in found)
        n = len(found)
        out[cid] = (n, "tentative" if not words else "verified" if n >= 2 and high else "tentative" if n else "flagged")
    return out


def test_claims_are_verified_by_records_and_files(spark):
    claims = [(1, "The sole Leather takes 8 oz of oil"), (2, "Nothing supports zebra quagga claims"), (3, "of a"), (4, "Soak hides for 12 hours in water"), (5, "")]
    records = [("r1", "Sole leather takes 8.5 oz oil"), ("r1", "sole leather takes 8 oz"), ("r2", "soak hides in water 40 hours"), ("r3", None)]
    files = [("f1", "x" * 500 + " The sole leather takes 8 oz of oil."), ("f2", "soak the hides in water" + " y" * 300 + " 12 hours"), ("low", "Soak hides 12 hours"), ("f4", "")]
    c = spark.createDataFrame(claims, "claim_id long, text string")
    words = {r.claim_id: r.k for r in c.select("claim_id", verify.keywords(F.col("text")).alias("k")).collect()}
    assert words[1][:2] == ["8 oz", "8"] or "leather" in words[1]
    assert words[3] == [] and words[5] == []
    got = verify.verify(c, spark.createDataFrame(records, "source string, text string"), spark.createDataFrame(files, "source string, text string"), spark.createDataFrame([("low",)], "source string"))
    want = plain_verify([(i, t, words[i]) for i, t in claims], [(s, t or "") for s, t in records], files, {"low"})
    assert {r.claim_id: (r.sources, r.confidence) for r in got.collect()} == want
    assert want[2][1] == "flagged" and want[3][1] == "tentative" and want[1][1] == "verified"
    w = spark.createDataFrame([("the sole leather takes 8 oz of oil and more",)], "sentence string")
    v = spark.createDataFrame([(1, "So: the sole leather takes 8 oz of oil and more", "verified"), (2, "x", "verified")], "claim_id long, text string, confidence string")
    assert sorted((r.claim_id, r.confidence) for r in verify.downgrade(v, w).collect()) == [(1, "flagged"), (2, "verified")]


def test_probes(spark):
    out = spark.createDataFrame([("Take 8 oz of oil for the hide [C1]. Then soak it for 12 hours in a tub. And leave it alone there.",)], "text string")
    r = probes.claim_attribution(out, 3).first()
    assert (r.verdict, r.sentences, r.specific, r.attributed, r.rate, r.hallucinated) == ("INCONCLUSIVE", 3, 2, 1, 0.5, 0)
    assert probes.claim_attribution(out, 0).first().verdict == "FAIL"
    assert probes.claim_attribution(out.limit(0), 3).first().verdict == "INCONCLUSIVE"
    calls = spark.createDataFrame([(1.0, False), (2.0, False), (3.5, False)], "seconds double, failed boolean")
    assert probes.call_latency(calls).first().verdict == "PASS" and probes.call_latency(calls.withColumn("failed", F.lit(True))).first().verdict == "FAIL"
    m = spark.createDataFrame([("a [C1] b [C2] c [C2].", 2, 0, 0, 0)], "content string, verified int, tentative int, flagged int, hallucinated int")
    assert probes.marker_verification(m).first().verdict == "PASS"
    assert probes.marker_verification(m.withColumn("hallucinated", F.lit(1))).first().verdict == "FAIL"
    nodes = spark.createDataFrame([(n,) for n in ("edge bevelers and burnishers", "saddle stitching", "Gameplay mechanics", "Election results 1872")], "node string")
    g = nodes.select(frontier.node_gate(F.col("node"), "leatherworking", ["awl", "burnisher", "stitch"])["allowed"].alias("allowed"), F.col("node").rlike("^[a-z]").alias("on_topic"))
    assert probes.drift_gate_precision(g).first().verdict == "PASS"


def test_topic_words_and_records(spark):
    assert R.topic_keywords("leatherworking") == ["leatherworking", "leather", "leather working", "leather work"]
    assert R.topic_roots("leatherworking") == ["leatherworking", "leatherwork", "leather"]
    assert R.own_vocabulary(["awl", "tool", "hide"], "x") and not R.own_vocabulary(["tool", "step"], "x")
    d = spark.createDataFrame([("Cut the hide along the line with an awl. Nice weather today, is it not so. Anneal to 8 oz of weight now.",), (None,), ("",)], "text string")
    got = d.select(R.practice(F.col("text"), ["awl"]).alias("p")).collect()
    assert [x["task"] for x in got[0].p] == ["Cut the hide along the line with an awl.", "Anneal to 8 oz of weight now."] and got[0].p[0]["tools"] == ["awl", "cut"]
    assert not got[1].p and got[2].p == []
    items = spark.createDataFrame([(" A claim of some length ", None, None, ["k"], "f", "reddit"), ("short", "X", None, None, "f", "hub")], "text string, type string, numeric array<string>, keywords array<string>, source_file string, source_name string")
    (r,) = R.claim_records(items).collect()
    assert (r.text, r.type, r.numeric, r.keywords, r.low_trust) == ("A claim of some length", "general", [], ["k"], True)
    img = spark.createDataFrame([("File:Edge beveler.svg", "", 500), ("File:Edge beveler photo.jpg", "", 100), ("File:Cat.png", "", 900)], "t string, d string, w int")
    assert [x[0] for x in img.select(R.image_score(F.col("t"), F.col("d"), F.col("w"), "edge beveler", ["logo"])).collect()] == [8, -2, -99]
    h = spark.createDataFrame([("### **2. Nails**\ntext\n\n### The Title!\n\nbody",)], "md string")
    a, b = h.select(R.plain_headings(F.col("md")), R.without_title(F.col("md"), F.lit("the title"))).first()
    assert a.startswith("### Nails\ntext") and b == "### **2. Nails**\ntext\n\nbody"
    names = spark.createDataFrame([("awl",), ("awls",), ("box",), ("boxes",)], "name string")
    assert sorted(r.name for r in R.without_plurals(names).collect()) == ["awl", "box"]


def test_connectors(spark, tmp_path):
    for source, node, rows in (("wiki", "awl", [{"identifier": "a", "title": "T"}, "bad", {"identifier": "b"}]), ("reddit", "hide", [{"identifier": 3}])):
        (tmp_path / "c" / source).mkdir(parents=True)
        (tmp_path / "c" / source / f"{node}.jsonl").write_text("\n".join(r if r == "bad" else json.dumps(r) for r in rows))
    got = C.candidates(spark, str(tmp_path / "c"))
    assert sorted((r.source, r.node, r.rank, r.identifier) for r in got.collect()) == [("reddit", "hide", 1, "3"), ("wiki", "awl", 1, "a"), ("wiki", "awl", 2, "b")]
    assert [r.identifier for r in got.where("source = 'reddit'").collect()] == ["3"]
    assert C.candidates(spark, str(tmp_path / "none")).count() == 0
    f = spark.createDataFrame([("s", "n", i, i in (1, 2, 3), False) for i in range(1, 9)], "source string, node string, rank int, saved boolean, high_value boolean")
    assert sorted(r.rank for r in C.successes(f).collect()) == [1, 2, 3]
    assert C.successes(f.withColumn("saved", F.lit(False))).count() == 5
    (tmp_path / "p.txt").write_text("ff\n\nzz\nFFFFFFFFFFFFFFFF\n")
    assert sorted((r.seq, r.fp) for r in C.saved_fingerprints(spark, str(tmp_path / "p.txt")).collect()) == [(0, 255), (3, -1)]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.gz").write_bytes(gzip.compress(b"hello"))
    (tmp_path / "raw" / "b.gz").write_bytes(b"\x1f\x8bbroken")
    (tmp_path / "raw" / "c.pdf").write_bytes(b"%PDF-1")
    assert sorted((r.file, r.text) for r in C.fetched(spark, str(tmp_path / "raw")).collect()) == [("a.gz", "hello"), ("b.gz", ""), ("c.pdf", "")]
    x = spark.createDataFrame([(["a.pdf", "a_text.txt", "a_djvu.txt"], False), (["a_text.txt"], True), (["a.png"], None)], "f array<string>, r boolean")
    assert [r[0] for r in x.select(C.best_file(F.col("f"), F.col("r"))).collect()] == ["a_djvu.txt", None, None]
    (tmp_path / "s.json").write_text('{"topic": "x", "n": 3}')
    assert C.state(spark, str(tmp_path / "s.json"), "topic string, n int").collect()[0].n == 3
    assert C.state(spark, str(tmp_path / "missing.json"), "topic string, n int").count() == 0


def test_reports(spark, tmp_path):
    quality = spark.createDataFrame([(2, 0.5, 0.6, 0.7), (1, 0.75, 0.8, 0.9)], "cycle int, score double, facts double, pedagogy double")
    none = spark.createDataFrame([], "kind string, cycle int, message string")
    agents = spark.createDataFrame([("a", 1, 3), ("b", 0, 0)], "source string, saves int, rejects int")
    events = spark.createDataFrame([("r", 1, 0.0, "p", "start"), ("r", 2, 2.5, "p", "end"), ("r", 3, 4.0, "p", "start")], "run_id string, seq int, ts double, phase string, type string")
    phases = reports.phase_timings(events)
    assert [(r.calls, r.total_sec, r.avg_sec) for r in phases.collect()] == [(2, 2.5, 1.25)]
    md = reports.run_summary("t", quality, none, agents, phases).first().markdown
    assert md.startswith("# Run Summary — t\n\n## Cycle Quality\n\n| Cycle | Score | Facts | Pedagogy |\n|---|---|---|---|\n| 1 | 0.75 | 80% | 90% |\n| 2 | 0.50 | 60% | 70% |\n\n## Alerts\n\n*No alerts raised.*")
    assert "| a | 1 | 3 | 25% |" in md and "| b |" not in md
    ch = spark.createDataFrame([(1, "One", 1, 1, 1, 0.5)], "no int, title string, verified int, tentative int, flagged int, score double")
    fl = spark.createDataFrame([(1, "One", "A claim", ["k", "l"])], "no int, title string, claim string, keywords array<string>")
    md = reports.fact_report("a_b", ch, fl).first().markdown
    assert md.startswith("# A B — Book Fact-Check Report") and "**3 claims checked**" in md and "| One | 3 | 1 | 1 | 1 | 50% |" in md and "Keywords searched: k, l" in md
    assert json.loads(reports.fact_json("t", ch).first().json)["summary"]["total_claims"] == 3
    thin = spark.createDataFrame([(1, "Edges")], "no int, title string")
    missing = spark.createDataFrame([(2, ["a", "b", "c", "d", "e"])], "no int, topics array<string>")
    unused = spark.createDataFrame([("f", ["z", "y"])], "file string, hits array<string>")
    nodes = [r.node for r in reports.gap_list("t", thin, missing, unused).orderBy("seq").collect()]
    assert nodes[:3] == ["t edges complete guide", "t edges techniques procedures", "t a"] and len(nodes) == 12 and nodes[-1] == "t z practical guide"
    idx = reports.index_report(spark.createDataFrame([("awl", 2), ("awl", 1), ("Box", 1)], "term string, chapter int")).first().markdown
    assert idx == "# Index\n\n### A\n\n- **awl** — 1, 2\n\n### B\n\n- **Box** — 1".replace("- ", "")
    new = spark.createDataFrame([("f1", "x"), ("f2", "y")], "source_file string, text string")
    assert reports.append_claims(spark, new, str(tmp_path / "db")).count() == 2
    assert reports.append_claims(spark, new, str(tmp_path / "db")).count() == 0


def test_frontier_runs_until_it_has_files_or_no_nodes(spark):
    nodes = spark.createDataFrame([("leather dyes", "pending", 1, 0, "seed"), ("gameplay", "pending", 9, 1, "seed"), ("leather awls", "grounded", 1, 2, "seed")], frontier.NODES)
    empty = spark.createDataFrame([], "node string, seq long")
    work = lambda b: b.select("node", F.when(F.col("node") == "leather dyes", 2).otherwise(0).alias("files"))
    state, n, why = frontier.harvest(nodes, "leather", ["burnisher", "tool"], work, lambda _: empty, 100, 5)
    got = {r.node: (r.status, r.files) for r in state.collect()}
    assert why == "no nodes" and n == 2
    assert got == {"leather dyes": ("grounded", 2), "gameplay": ("stalled", 0), "leather awls": ("grounded", 0), "burnisher": ("stalled", 0)}
    assert frontier.harvest(nodes, "leather", [], work, lambda _: empty, 2, 5)[1:] == (1, "enough files")
    q = spark.createDataFrame([(f"u{i}", i, i == 0) for i in range(8)], "url string, seq int, consumed boolean")
    taken, left = frontier.take_cited(q)
    assert sorted(r.url for r in taken.collect()) == ["u1", "u2", "u3", "u4", "u5"] and left.where("NOT consumed").count() == 2


def test_model_calls():
    waits, tries = [], []
    s = B.Settings(sleep=waits.append)

    def busy(p):
        tries.append(p)
        if len(tries) < 3:
            raise B.Busy if len(tries) == 1 else B.Unreachable
        return "<think>x</think> yes"

    assert B.ask(busy, "p", s) == "yes" and waits == [15.0, 20.0]
    assert B.ask_firmly(B.silent, "p", s) == "" and not B.healthy(B.silent, s)


def test_a_record_is_found_by_the_numbers_noted_beside_it(spark):
    claims = spark.createDataFrame([(1, "Soak leather strips for 40 minutes", ["leather", "strips"])], "claim_id long, text string, keywords array<string>")
    rows = [("a", "leather strips are soaked", ["42 min", "x"]), ("b", "leather strips are soaked", ["90 min"]), ("c", "leather strips are soaked", None), ("d", "leather strips, 38 of them", [])]
    got = verify.supported_by_claims(spark.createDataFrame(rows, "source string, text string, numeric array<string>"), claims)
    assert {r.source for r in got.collect()} == {"a", "d"}


def test_words_of_practice_sentences_end_at_letters_that_are_not_ascii(spark, tmp_path):
    import duckdb

    from corpusloom import catalog

    texts = ["Une pièce écut 5 mm de long.", "Das Stück 12 mmé, cutü und dann.", "Cut ñ5 mm of the plate, please.", "Prefité xcut 5 mmx of the plate.", "Ein Stück, 30 minñ lang, fité nun."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES["practice_tasks"](spark, str(tmp_path)).select("doc_id", "tasks").collect()]
    assert sorted(got) == sorted(c.execute(catalog.ORACLE["practice_tasks"]).fetchall()) and len(got) > 2


def test_pairs_of_claims_and_texts_go_out_in_small_frames():
    """Before, a batch's pairs were one frame: of 10,000 short texts and 4,096 claims up to forty million."""
    block = verify.Claims([(i, "always so", ["always"]) for i in range(60)])
    texts = pd.DataFrame({"source": [str(i) for i in range(2_000)], "text": ["It is always so." if i % 2 else None for i in range(2_000)], "more": [[]] * 2_000})
    frames = list(verify._matched(block, verify._same_number)(iter([texts, texts[:0], texts])))
    assert max(len(f) for f in frames) <= verify.PAIRS and sum(len(f) for f in frames) == 2 * 60 * 1_000
    got = pd.concat(frames)
    assert len(got.drop_duplicates()) == 60 * 1_000 and {int(s) % 2 for s in got.source} == {1}
