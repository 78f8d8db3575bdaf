"""The funnel's gates in their order, and verdicts asked for once."""

from pyspark.sql import functions as F

from corpusloom.operators import gates, verdicts

VAULT = "doc_id long, text string, lang string, source_name string, min_hits int, html_gate boolean, min_length int"


class Judge:
    """Counts what it is asked, in a file: backends run in workers."""

    def __init__(self, path, answer):
        self.path, self.answer = str(path), answer

    def __call__(self, prompt):
        with open(self.path, "a") as f:
            f.write("x")
        return self.answer(prompt)

    def asked(self):
        try:
            with open(self.path) as f:
                return len(f.read())
        except FileNotFoundError:
            return 0


def test_a_text_is_asked_for_once(spark, tmp_path):
    v = verdicts.Verdicts(spark, f"file://{tmp_path}/verdicts")
    judge = Judge(tmp_path / "asked", lambda p: "Yes!" if "good" in p else "" if "mute" in p else "no")
    rows = spark.createDataFrame([(1, "a", "good one"), (2, "a", "good one"), (3, "b", "good one"), (4, "a", "bad"), (5, "a", "mute"), (6, "a", None), (7, None, "bad")], "id long, topic string, sample string").repartition(3)
    want = {1: True, 2: True, 3: True, 4: False, 5: None, 6: None, 7: False}
    assert {r.id: r.verdict for r in v.of(rows, judge).collect()} == want and judge.asked() == 5
    assert v.ask(rows, judge) == 1 and judge.asked() == 6  # what had no answer is asked again, nothing else
    assert {r.id: r.verdict for r in v.of(rows.union(spark.createDataFrame([(8, "a", "bad")], rows.schema)), lambda p: "yes").collect()} == {**want, 5: True, 8: False}
    assert v.of(rows.limit(0), judge).count() == 0


def test_the_first_gate_that_rejects_names_it(spark, tmp_path):
    ok = "that with this from tion ment " + "word here. " * 300
    rows = [
        (1, "Poems of old\n" + ok, False), (2, "<html>" + ok, True), (3, "short", False), (4, ("x " * 60 + "\n") * 80, False), (5, "plain prose. " * 300, False), (6, ok, False), (7, ok + "!", False), (8, ok[:2400], False), (9, ok[:2400], False),
        (10, None, False), (11, "elle rewh. " + "plain prose. " * 300, False), (12, "elle orre. " + "other prose. " * 300, False), (13, "<html>" + ok, False),
    ]
    vault = spark.createDataFrame([(i, t, "en", "s", 2, html, 1000) for i, t, html in rows], VAULT)
    judge = Judge(tmp_path / "asked", lambda p: "no" if "plain" in p else "yes")
    got = {r.doc_id: r.gate for r in gates.admission(vault, verdicts.Verdicts(spark, f"file://{tmp_path}/verdicts"), judge).collect()}
    assert got == {1: "title", 2: "length", 3: "length", 4: "ocr", 5: "drift", 6: "admitted", 7: "dedup", 8: "admitted", 9: "admitted", 10: "length", 11: "drift", 12: "admitted", 13: "dedup"}
    assert judge.asked() == 2  # texts with markers enough aren't asked for


def test_guards(spark):
    files = spark.createDataFrame([("a", "x" * 300), ("b", "  " + "x" * 199 + "\n"), ("c", "y" * 2000), ("d", None)], "file string, text string")
    got = {r.file: len(r.sample) for r in verdicts.unclassified(files, files.where("file = 'a'")).collect()}
    assert got == {"c": 1200}
    c = spark.createDataFrame([("i1", 1), ("i2", 2)], "identifier string, n int")
    assert [r.n for r in verdicts.not_skipped(c, c.where("n = 1").union(c.where("n = 1"))).collect()] == [2]


def test_texts_are_lowered_and_split_once_not_for_each_term(spark):
    d = spark.createDataFrame([(1, "The Holy Bible\nand \x01more", "en"), (2, "A manual\nof the bible with that and this motion", "en"), (3, None, "fr"), (4, "", "en"), (5, "mente para", "es")], "id int, text string, lang string")
    out = d.select("id", gates.title_blocked(gates.first_line(F.col("text"))).alias("blocked"), gates.keyword_hits().alias("hits"))
    assert [(r.blocked, r.hits) for r in out.orderBy("id").collect()] == [(True, 0), (False, 3), (None, 0), (False, 0), (False, 2)]
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "contains(lower(" not in plan and "split_part" not in plan
