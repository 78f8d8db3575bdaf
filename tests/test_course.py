"""Practice pools, outlines and searches; sentences with foreign tools; sections of sources."""

from pyspark.sql import functions as F

from corpusloom.operators import course, sections

LEXICON = ["leather", "awl", "thread"]
FILES = "book string, file long, text string, n int"


def test_a_pool_reads_the_largest_dense_files_and_keeps_each_task_once(spark):
    task = "Punch the leather with an awl at 3 mm depth."
    big = f"{task} Cut the thread near the leather edge. Nothing is said here at all."
    rows = [("b", 2, big, 0), ("b", 1, f"{task} leather awl thread", 0), ("b", 3, "leather awl only. " + task, 0), ("b", 4, None, 0), ("c", 5, "", 0), (None, 6, big, 0)]
    got = course.practice_pool(spark.createDataFrame(rows, FILES), LEXICON).collect()
    assert sorted((r.book or "", r.file, r.task) for r in got) == [("", 6, "Cut the thread near the leather edge."), ("", 6, task), ("b", 2, "Cut the thread near the leather edge."), ("b", 2, task)]
    assert {tuple(r.tools) for r in got if r.task == task} == {("awl", "leather", "punch")}
    only = course.practice_pool(spark.createDataFrame(rows, FILES), LEXICON, 1).where("book = 'b'")
    assert {r.file for r in only.collect()} == {2}
    assert course.practice_pool(spark.createDataFrame([], FILES), LEXICON).count() == 0


def test_an_outline_has_the_books_tools_and_fitting_lexicon_entries(spark):
    books = spark.createDataFrame([("edge_work", [f"t{i}" for i in range(9)]), ("bare", None)], "book string, tools array<string>")
    lexicon = ["safety glasses", "wood finish", "t1 blade", "history of hides", "finish oil", "origin"]
    got = {(r.book, r.n): r for r in course.outline(books, lexicon).collect()}
    assert len(got) == 22
    one = got["edge_work", 1]
    assert one.title == "Introduction to Edge Work" and one.topics == ["history", "overview", "fundamentals", "scope", "history of hides", "origin", "history of hides"]
    assert one.keys == ["history", "overview", "fundamentals", "scope", "history of hides"]
    assert got["edge_work", 3].topics == [f"t{i}" for i in range(8)] + ["t1 blade"] and got["bare", 3].topics == []
    assert got["bare", 8].topics == ["finish", "surface", "wood finish", "finish oil", "wood finish", "finish oil"]
    assert got["bare", 2].keys == ["safety", "ppe", "workspace", "hazards", "safety glasses"]
    pool = spark.createDataFrame([("bare", "FINISH the surface"), ("bare", "nothing"), ("edge_work", "use t3 here"), ("gone", "finish")], "book string, task string")
    refs = course.references(course.outline(books, lexicon), pool)
    assert sorted(map(tuple, refs.collect())) == [("bare", 8, "FINISH the surface"), ("edge_work", 3, "use t3 here")]


def test_a_summary_lists_the_first_tasks_in_order(spark):
    rows = [("b", 1, 7, 0, i, f"task {i}", ["awl", "go"] if i % 2 else []) for i in range(25)] + [("c", 1, 8, 0, 0, "sole task", [])]
    pool = spark.createDataFrame(rows, "book string, place int, file long, chunk int, n int, task string, tools array<string>").repartition(5)
    got = {r.book: r for r in course.summary(pool).collect()}
    assert got["b"].tools == ["awl"]
    assert got["b"].text == "Tasks covered:\n" + "\n".join(f"- task {i}" for i in range(20)) + "\n\nTools/materials mentioned:\n- awl\n- go"
    assert got["c"].tools == [] and got["c"].text == "Tasks covered:\n- sole task"


def test_searches_are_quoted(spark):
    from urllib.parse import quote_plus

    words = ["a b*c ~d", "é & ü", "", "50% + /x?"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(course.search_url(F.col("w")).alias("u")).collect()
    assert [r.u for r in got] == [course.SEARCH + quote_plus(w) for w in words]


def test_sentences_with_foreign_tools_go(spark):
    rows = [
        (1, "Cut it.  An ANVIL is heavy! Next one. Use the lathe\nand go on.\n\n\n\nAnvils stay. The bench plane stays. A forge? End"),
        (2, "Nothing foreign."), (3, None), (4, ""), (5, "Use the bench plane here."), (6, "anvil " * 50_000),
    ]
    d = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: (r.text, r.stripped) for r in sections.without_foreign(d, "leather_working tools leatherworking").collect()}
    assert got[1] == ("Cut it. Next one. Use the lathe\nand go on.\n\nAnvils stay. The bench plane stays. End", 2)
    assert got[2] == ("Nothing foreign.", 0) and got[3] == (None, 0) and got[4] == ("", 0) and got[5] == ("Use the bench plane here.", 0)
    assert got[6] == ("anvil " * 50_000, 0)
    assert {r.stripped for r in sections.without_foreign(d, "pottery").collect()} == {0}
    assert sections.foreign_tools("Blacksmith") == ["leather punch", "skiving knife", "bench plane", "router table", "sewing machine", r"awl(?!\s*shape)"]


def test_a_section_lists_sources_and_flagged_claims(spark):
    chapters = spark.createDataFrame([(1, "Body."), (2, None), (3, "Alone.")], "chapter int, text string")
    claims = spark.createDataFrame([(1, 2, "later", "flagged"), (1, 1, "first", "flagged"), (1, 3, "x", "verified"), (2, 4, "y", "tentative")], "chapter int, claim_id int, text string, confidence string")
    files = spark.createDataFrame([(1, "b.md"), (1, "a.md"), (1, "a.md")], "chapter int, file string")
    got = {r.chapter: r.text for r in sections.with_sources(chapters, claims, files).collect()}
    head = "\n\n---\n\n### Chapter Sources & Verification\n"
    assert got[3] == "Alone." + head and got[2] == head
    assert got[1] == (
        "Body." + head + "\n**Source files used:**\n\n- `a.md`\n- `b.md`\n\n\n**⚠ 2 claim(s) could not be verified against source material:**\n\n- *first*\n- *later*\n\n"
        "*These claims may be accurate but were not found in the collected source files. Verify independently before relying on them.*\n\n*1/3 claims cross-referenced to source material.*"
    )
