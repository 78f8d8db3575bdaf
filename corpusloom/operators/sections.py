"""Structure of books in markdown: headings, a title's slice of its book, sections that a book has twice, chapters off their topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import FOREIGN_TOOLS, PEDAGOGY_HEADINGS

THIN_WORDS = 500
DRIFT_DENSITY = 0.5
NUMBER = r"^\d+[.)]\s*"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def found_headings(lines: Column, most: int = 4) -> Column:
    """Level, title, normalised title (lower case, without a number before it), and line of each heading of level 2 and below."""

    def one(line: Column, i: Column) -> Column:
        title = F.btrim(F.regexp_replace(line, r"^#+\s+", ""), F.lit(" \t\r"))
        norm = F.btrim(F.regexp_replace(F.lower(title), NUMBER, ""))
        return F.when(line.rlike(rf"^#{{2,{most}}}\s+\S"), F.struct(F.length(F.regexp_extract(line, "^(#+)", 1)).alias("level"), title.alias("title"), norm.alias("norm"), i.alias("line")))

    return F.filter(F.transform(lines, one), lambda h: h.isNotNull())


def spans(lines: Column, most: int = 4) -> Column:
    """The sections of a text: from each heading to the next (begin, end: lines), and what stands before the first, with
    no title. They are made where the text is; nothing is shuffled."""
    head = F.struct(F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("norm"), F.lit(0).alias("line"))

    def cut(x: Column) -> Column:
        n = F.size(x["l"])
        all_ = F.concat(F.array(head), x["h"])
        return F.transform(all_, lambda h, i: F.struct(h["level"].alias("level"), h["title"].alias("title"), h["norm"].alias("norm"), h["line"].alias("begin"), F.coalesce(F.get(all_, i + 1)["line"], n).alias("end")))

    return X.with_(F.struct(lines.alias("l"), found_headings(lines, most).alias("h")), cut)


def slices(books: DataFrame, titles: DataFrame) -> DataFrame:
    """book, n, title and content of each title (book, n, title) that its book (book, text) has as a heading of level 2:
    from the title's first such heading to the next heading that is a title. Numbers and case of headings don't matter.
    Titles without a heading have no row; of titles with the same heading all but the last are empty."""
    h = books.select("book", F.explode(found_headings(_lines(F.col("text")), 2)).alias("h"))
    forms = F.array_distinct(F.array(F.lower("h.title"), F.col("h.norm")))  # a title may itself begin with a number
    places = h.select("book", F.explode(forms).alias("norm"), F.col("h.line").alias("line")).groupBy("book", "norm").agg(F.min("line").alias("begin"))
    found = titles.withColumn("norm", F.lower(F.btrim("title"))).join(places, ["book", "norm"])
    ends = F.lead("begin").over(Window.partitionBy("book").orderBy("begin", "n"))
    cut = found.select("book", "n", "title", "begin", ends.alias("end"))
    lines = books.select("book", _lines(F.col("text")).alias("l"))
    size = F.coalesce("end", F.size("l")) - F.col("begin")
    return cut.join(lines, "book").select("book", "n", "title", F.array_join(F.slice("l", F.col("begin") + 1, size), "\n").alias("content"))


def checks(chapters: DataFrame) -> DataFrame:
    """What a quality gate counts in each chapter (content): words, thinness, and its teaching parts."""
    has = lambda p: F.col("content").rlike(p)
    words = X.word_count(F.col("content"))
    return chapters.withColumns({"words": words, "thin": words < THIN_WORDS, "outcomes": has(r"(?i)##\s+learning outcomes"), "try_this": has(r"(?i)\btry this\b"), "questions": has(r"(?i)##\s+review questions")})


def without_repeats(chapters: DataFrame) -> DataFrame:
    """book, chapter, text and trimmed: of sections of level 2 to 4 with one heading the book's first stays, by chapter and
    line; the others go up to the next heading. Headings of teaching parts may repeat. First places are aggregates, so a
    heading that a whole book shares is no group in one task."""
    cut = chapters.select("book", "chapter", _lines(F.col("text")).alias("l")).withColumn("s", spans(F.col("l")))
    s = cut.select("book", "chapter", F.explode("s").alias("s")).where(F.col("s.norm").isNotNull() & ~F.col("s.norm").isin(PEDAGOGY_HEADINGS))
    s = s.select("book", "chapter", F.col("s.norm").alias("norm"), F.col("s.begin").alias("begin"))
    first = s.groupBy("book", "norm").agg(F.min(F.struct("chapter", "begin")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = s.join(first.drop("n"), ["book", "norm"]).where("chapter <> first.chapter OR begin <> first.begin")
    drops = later.groupBy("book", "chapter").agg(F.collect_list("begin").alias("drops"))
    kept = F.filter("s", lambda x: ~F.array_contains("drops", x["begin"]) | x["norm"].isNull())
    text = F.array_join(F.flatten(F.transform(kept, lambda x: F.slice("l", x["begin"] + 1, x["end"] - x["begin"]))), "\n")
    squeezed = F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    out = cut.join(drops, ["book", "chapter"], "left")
    return out.select("book", "chapter", F.when(F.col("drops").isNull(), F.array_join("l", "\n")).otherwise(squeezed).alias("text"), F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).alias("trimmed"))


def chapter_roots(topic: str) -> list[str]:
    """The topic's phrase, its words of six letters and more, and what these are without an ending of a craft."""
    phrase = topic.replace("_", " ").lower()
    long = [w for w in phrase.split() if len(w) > 5]
    stems = [w.removesuffix(e) for w in long for e in ("working", "smithing", "making", "ing") if w.endswith(e) and len(w) > len(e) + 3]
    return sorted({phrase, *long, *stems})


def density(text: Column, roots: list[str]) -> Column:
    """Occurrences of all roots (one within another counts for both) for each 100 words."""
    low = F.lower(text)
    hits = sum((X.occurrences(low, F.lit(r)) for r in roots[1:]), X.occurrences(low, F.lit(roots[0])))
    return hits / (F.greatest(X.word_count(text), F.lit(1)) / 100)


def on_topic(chapters: DataFrame, topic: str) -> DataFrame:
    """Chapters (text, topics) with `drifted`; the text of a drifted one is a stub that names up to eight expected topics, and
    all its topics are missing."""
    drifted = density(F.col("text"), chapter_roots(topic)) < DRIFT_DENSITY
    stub = F.concat(F.lit(f"## Summary\n\n*Removed: the draft left the topic, {topic.replace('_', ' ').lower()}.*\n\n**Expected topics:** "), F.array_join(F.slice("topics", 1, 8), ", "))
    rest = [c for c in chapters.columns if c not in ("text", "missing")]
    missing = F.col("missing") if "missing" in chapters.columns else F.array().cast("array<string>")
    return chapters.withColumn("drifted", F.coalesce(drifted, F.lit(True))).select(*rest, "drifted", F.when(F.col("drifted"), stub).otherwise(F.col("text")).alias("text"), F.when(F.col("drifted"), F.col("topics")).otherwise(missing).alias("missing"))


def foreign_tools(topic: str, lists: dict[str, list[str]] = FOREIGN_TOOLS) -> list[str]:
    """The tools foreign to a topic: those of all crafts that its name holds or that hold its name."""
    name = topic.replace("_", " ").lower().strip()
    return list(dict.fromkeys(t for craft, tools in lists.items() if craft in name or name in craft for t in tools))


def without_foreign(chapters: DataFrame, topic: str, lists: dict[str, list[str]] = FOREIGN_TOOLS) -> DataFrame:
    """Chapters (text) without the sentences that name a tool foreign to the topic, and `stripped`, the number of these. A
    sentence ends with . ! or ?, and begins after such a mark or in a line of its own. Tools are looked for without a b at
    their ends, as the behaviour being matched does, so sentences with a bench plane stay. Null texts stay null."""
    tools = foreign_tools(topic, lists)
    if not tools:
        return chapters.withColumn("stripped", F.lit(0))
    one = lambda names: rf"(?iU)\b(?:{'|'.join(names)})\b"
    text = F.coalesce("text", F.lit(""))
    found = one([t.strip("b") for t in tools])
    # parts that end with a mark or a line; a part is looked at once, so the work is linear in the text
    parts = F.transform(F.split(text, r"(?<=[.!?\n])"), lambda p: F.when(~(p.rlike(r"[.!?]$") & p.rlike(found)), p))
    cut = X.with_(parts, lambda v: F.struct(F.size(F.filter(v, lambda p: p.isNull())).alias("n"), F.array_join(F.transform(v, lambda p: F.coalesce(p, F.lit(" "))), "").alias("text")))
    out = chapters.withColumn("stripped", F.when(text.rlike(one(tools)), cut).otherwise(F.struct(F.lit(0).alias("n"), text.alias("text"))))
    squeezed = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("stripped.text"), " {2,}", " "), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    return out.withColumns({"text": F.when(F.col("stripped.n") > 0, squeezed).otherwise(F.col("text")), "stripped": F.col("stripped.n")})


def with_sources(chapters: DataFrame, claims: DataFrame, files: DataFrame) -> DataFrame:
    """Chapters (chapter, text) with a section behind that lists the files (chapter, file) in order, the flagged ones of claims
    (chapter, claim_id, text, confidence), and how many were verified. The lists are a chapter's own output; they are gathered
    by chapter before the text joins."""
    f = files.groupBy("chapter").agg(F.array_sort(F.collect_set("file")).alias("files"))
    flagged = F.array_sort(F.collect_list(F.when(F.col("confidence") == "flagged", F.struct("claim_id", "text"))))
    c = claims.groupBy("chapter").agg(flagged.alias("flagged"), F.count_if(F.col("confidence") == "verified").alias("verified"), F.count("*").alias("n"))
    empty = F.array().cast("array<string>")
    listed = F.concat(F.lit("**Source files used:**\n\n"), F.array_join(F.transform("files", lambda x: F.concat(F.lit("- `"), x, F.lit("`"))), "\n"), F.lit("\n"))
    warned = F.concat(
        F.lit("\n**⚠ "), F.size("flagged").cast("string"), F.lit(" claim(s) could not be verified against source material:**\n\n"),
        F.array_join(F.transform("flagged", lambda x: F.concat(F.lit("- *"), x["text"], F.lit("*"))), "\n"),
        F.lit("\n\n*These claims may be accurate but were not found in the collected source files. Verify independently before relying on them.*"),
    )
    checked = F.concat(F.lit("\n*"), F.col("verified").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" claims cross-referenced to source material.*"))
    parts = F.array_compact(F.array(F.lit("\n\n---\n\n### Chapter Sources & Verification\n"), F.when(F.size("files") > 0, listed), F.when(F.size("flagged") > 0, warned), F.when(F.col("verified") > 0, checked)))
    j = chapters.join(f, "chapter", "left").join(c, "chapter", "left").withColumn("files", F.coalesce("files", empty))
    return j.select("chapter", F.concat(F.coalesce("text", F.lit("")), F.array_join(parts, "\n")).alias("text"))
