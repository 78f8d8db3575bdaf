"""Folds over markdown: the cases that the behaviour to match pins down, in our own words."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import markdown as M

TABLE = "Before\n\n| Tool | Use |\n|---|:-:|\n| **Awl** | holes |\n|  |  |\n| Maul | force |\nAfter"
WIDE = "| Tool | Use | Size | Note: |\n|--|--|--|--|\n| Awl | holes | 2 | |\n| | | | |\n"
THREE = "| Tool | Use | Note: |\n|--|--|--|\n| Awl | holes | sharp |\n| Maul | force! | |\n| short |\n"


def test_tables_become_lists():
    assert M.tables_to_lists(TABLE) == ("Before\n\n- **Awl** — holes\n- **Maul** — force\nAfter", 1)
    assert M.tables_to_lists(WIDE) == ("\n**Awl**\n- *Use:* holes\n- *Size:* 2\n", 1)
    assert M.tables_to_lists(THREE) == ("- **Awl** — holes. *Note:* sharp\n- **Maul** — force!\n", 1)
    assert M.tables_to_lists("| a |\n|---|\n| b |") == ("- b", 1)
    assert M.tables_to_lists("| a | b |\nno rule") == ("| a | b |\nno rule", 0)
    assert M.tables_to_lists("") == ("", 0)


def test_terms_link_once_outside_headings_and_code():
    md = "# Saddle stitch\n```\nsaddle stitch\n```\nA Saddle Stitch, then a stitch and a saddle stitch.\nstitch-like [stitch]"
    text, n = M.link_terms(md, ["stitch", "saddle stitch", "stitch"])
    assert n == 2 and text.startswith("# Saddle stitch\n```\nsaddle stitch\n```\nA [Saddle Stitch](#glossary-saddle-stitch), then a [stitch](#glossary-stitch) and")
    assert M.link_terms(md, []) == (md, 0)


def test_acronyms_are_spelled_out_at_first_and_bare_later():
    md = "lead ABC\n## One\nABC (a b c) ABC ABC ABC (a b c) ABC XYZ\n## Two\nABC"
    text, n = M.expand_acronyms(md)
    assert n == 4
    assert text == "lead ABC\n## One\nABC (a b c) ABC (a b c) ABC (a b c) ABC ABC XYZ\n## Two\nABC (a b c)"
    assert M.expand_acronyms("## One\nABC") == ("## One\nABC", 0)


@pytest.mark.parametrize(
    ("md", "gone"),
    [
        ("Heat the plate to 105 oz before you start. The neighbour sentence stays here.", 1),
        ("Use leather of 8 oz for the sole of the shoe.", 0),
        ("Use leather of 9 oz for the sole of the shoe.", 0),  # within 15 %
        ("Use leather of 8 kg for the sole of the shoe.", 1),
        ("## Try This\n\nCut a strip of 400 mm and fold it twice.", 0),
        ("## Summary\n\nCut 400 mm of it first.\n\n## Next\n\nCut a strip of 400 mm and fold it twice.", 1),
        ("- Cut a strip of 400 mm and fold it twice.", 0),
        ("It was first described in 1850 by a smith.", 1),
        ("See ASTM D2813 for the whole procedure.", 1),
        ("Short 400 mm.", 0),
    ],
)
def test_sentences_that_no_claim_supports_go(md, gone):
    text, _, dropped, _ = M.drop_unsupported(md, ["The sole takes leather of 8 oz", "Two needles cross"])
    assert dropped == gone and ("neighbour" not in md or text == "The neighbour sentence stays here.")
    assert M.drop_unsupported(md, []) == (md, 0, 0, 0)


def test_folds_as_columns(spark):
    df = spark.createDataFrame([(1, TABLE, ["Awl"]), (2, None, None), (3, "", [])], "id int, md string, terms array<string>")
    rows = df.select("id", M.tables_to_lists_udf("md").alias("t"), M.link_terms_udf("md", "terms").alias("l"), M.expand_acronyms_udf("md").alias("a"), M.drop_unsupported_udf("md", "terms").alias("d")).orderBy("id").collect()
    assert [r["t"]["n"] for r in rows] == [1, 0, 0] and [r["l"]["n"] for r in rows] == [1, 0, 0]
    assert rows[1]["a"]["text"] == rows[1]["d"]["text"] == ""


def test_era_flags(spark):
    old = "Traditionally the hides were once used in this way, and historically they were smoked for many days."
    df = spark.createDataFrame([("\n\n".join([old, old + " Today they are not.", "# " + old, "Traditionally and historically."]),), (None,)], "md string")
    flagged, empty = [r[0] for r in df.select(M.flag_era(F.col("md"))).collect()]
    assert empty is None
    assert [p.startswith("> ⏳ **Historical practice:** ") for p in flagged.split("\n\n")] == [True, False, False, False]


def test_names_that_no_claim_has_are_counted_and_stay():
    md = "The clamps were made by Amy Roke and sold in North America for years. Hold them as The Smith does, by Table Of Contents.\n\n## Try This\n\nAsk John Doe Smith about the awl that he uses."
    text, seen, dropped, names = M.drop_unsupported(md, ["John Doe Smith makes awls"])
    assert (text, seen, dropped, names) == (md, 2, 0, 1)
    assert M.drop_unsupported(md, ["amy roke clamps"])[3] == 0
