"""Material for a course: the practice sentences of a book's largest files, an outline made without a model, tools, tasks and
searches. A book is any group of files; its rows stay rows, only tools (of fixed lists) and the first tasks are gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import text as X
from ..functions.lists import OUTLINE

MOST_FILES = 80
SAMPLE_CHARS = 20_000
LEAST_DENSITY = 3
CHUNK_WORDS = 300
FIRST_TASKS = 20
SEARCH = "https://www.youtube.com/results?search_query="


def practice_pool(files: DataFrame, lexicon: list[str], most_files: int = MOST_FILES) -> DataFrame:
    """book, place, file, chunk, n, task and tools: the practice sentences of files (book, file, text), each task once a book,
    where it comes first. Of a book its `most_files` largest files (bytes; ties by file) are read, and of these the ones whose
    first 20,000 characters hold three lexicon entries. Null texts are empty."""
    f = files.select("book", "file", F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.octet_length("text"))
    place = F.row_number().over(Window.partitionBy("book").orderBy(F.desc("size"), "file"))
    f = f.withColumn("place", place).where(F.col("place") <= most_files).where(X.density(F.left("text", F.lit(SAMPLE_CHARS)), lexicon) >= LEAST_DENSITY)
    c = f.select("book", "place", "file", F.posexplode(X.chunks(F.col("text"), CHUNK_WORDS)).alias("chunk", "c"))
    t = c.select("book", "place", "file", "chunk", F.posexplode(R.practice(F.col("c"), lexicon)).alias("n", "p"))
    first = t.groupBy("book", F.col("p.task").alias("task")).agg(F.min(F.struct("place", "file", "chunk", "n", "p.tools")).alias("at"))
    return first.where("task <> ''").select("book", "at.place", "at.file", "at.chunk", "at.n", "task", "at.tools")


def tools(pool: DataFrame) -> DataFrame:
    """book and tools: its distinct tools in order; there are no more than action verbs and lexicon entries."""
    each = pool.select("book", F.explode("tools").alias("tool")).distinct()
    return each.groupBy("book").agg(F.array_sort(F.collect_set("tool")).alias("tools"))


def outline(books: DataFrame, lexicon: list[str]) -> DataFrame:
    """book, n, title and topics of the eleven chapters of each of books (book, tools) that no plan was made for. Topics are
    the template's (its third chapter takes the first eight tools), up to six lexicon entries that hold one of its keywords,
    and up to four that hold one of the first four topics."""
    terms = [t for t in lexicon if t]
    all_ = X.arr(terms) if terms else F.array().cast("array<string>")
    label = F.initcap(F.regexp_replace(F.coalesce(F.col("book"), F.lit("")), "_", " "))

    def chapter(n: int, title: str, topics: list[str] | None, keywords: list[str]) -> Column:
        mine = [t for t in terms if any(k in t.lower() for k in keywords)][:6]
        head = X.arr(topics) if topics else F.transform(F.slice(F.coalesce("tools", F.array().cast("array<string>")), 1, 8), F.lower)
        base = F.concat(head, X.arr(mine)) if mine else head
        near = lambda b: F.concat(b, F.slice(F.filter(all_, lambda t: F.exists(F.slice(b, 1, 4), lambda k: F.contains(t, k))), 1, 4))
        name = F.concat(F.lit(title), label) if title.endswith(" ") else F.lit(title)
        return F.struct(F.lit(n).alias("n"), name.alias("title"), X.with_(base, lambda b: F.struct(near(b).alias("topics"), F.size(b).alias("own"))).alias("t"))

    rows = books.select("book", F.explode(F.array(*[chapter(i + 1, *c) for i, c in enumerate(OUTLINE)])).alias("c"))
    return rows.select("book", "c.n", "c.title", F.col("c.t.topics").alias("topics"), F.slice("c.t.topics", 1, F.least("c.t.own", F.lit(5))).alias("keys"))


def references(chapters: DataFrame, pool: DataFrame) -> DataFrame:
    """book, n and task of the tasks that name one of an outline's chapter's first five topics: each task meets the eleven
    chapters of its book."""
    met = pool.select("book", "task").join(chapters.select("book", "n", "keys"), "book")
    return met.where(F.exists("keys", lambda k: F.contains(F.lower("task"), k))).select("book", "n", "task")


def summary(pool: DataFrame) -> DataFrame:
    """book, tools (longer than two characters) and text: a book's first 20 tasks, and its first 20 tools."""
    w = Window.partitionBy("book").orderBy("place", "chunk", "n")
    first = pool.withColumn("i", F.row_number().over(w)).where(F.col("i") <= FIRST_TASKS)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("i", "task"))), lambda t: F.concat(F.lit("- "), t["task"]))
    tasks = first.groupBy("book").agg(F.array_join(listed, "\n").alias("tasks"))
    more = F.concat(F.lit("\n\nTools/materials mentioned:\n"), F.array_join(F.transform(F.slice("tools", 1, 20), lambda t: F.concat(F.lit("- "), t)), "\n"))
    text = F.concat(F.lit("Tasks covered:\n"), F.col("tasks"), F.when(F.size("tools") > 0, more).otherwise(""))
    both = tasks.join(tools(pool), "book", "left").withColumn("tools", F.coalesce("tools", F.array().cast("array<string>")))
    return both.select("book", F.filter("tools", lambda t: F.length(t) > 2).alias("tools"), text.alias("text"))


def search_url(words: Column) -> Column:
    """A search's address: blanks are +, and only letters, digits and _ . - ~ stay as they are."""
    return F.concat(F.lit(SEARCH), F.replace(F.replace(F.url_encode(words), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")))


def searches(pool: DataFrame) -> DataFrame:
    """book, area and url of each skill area, which is a task's first four words."""
    areas = pool.select("book", F.array_join(F.slice(X.tokens(F.col("task")), 1, 4), " ").alias("area")).distinct()
    return areas.withColumn("url", search_url(F.col("area")))
