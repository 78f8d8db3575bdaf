"""A stored inverted index of files, and the passages that chapters get through it.

The index has five tables under one path. `grams` leads from three letters to the tokens that hold them, `postings` from a
token to its files (and, of headings, to their numbers); both are partitioned by a bucket of their key, and a search reads
the buckets of what it asks for and no others. `tokens` has each token once, `files` words and lengths, `texts` the texts in
buckets of the file.

A term matches as a part of the lower-cased text. One without blanks does so where a token holds it, so tokens decide; of
one with blanks the files that have all its parts are looked at in `texts`. Terms under three letters go through all tokens
(the vocabulary, not the texts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.scratch import stored

BUCKETS = 16
GRAM = 3
#: Files of a chapter, their share of the best score at least, characters of its passages, least length of one.
FILES, SHARE, BUDGET, LEAST = 15, 0.25, 20_000, 60
FALLBACK_FILES, FALLBACK_CHARS = 3, 1800


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _grams(word: Column) -> Column:
    n = F.length(word)
    return F.when(n >= GRAM, F.array_distinct(F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substring(word, i, GRAM)))).otherwise(F.array(word))


class Index:
    """An index at `path`; build() writes it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def _write(self, rows: DataFrame, name: str) -> None:
        """Rows of a bucket lie together; where one is large (a word that all files have), AQE splits it."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def table(self, name: str, bucket: list[int] | None = None) -> DataFrame:
        t = self.spark.read.parquet(f"{self.path}/{name}")
        return t if bucket is None else t.where(F.col("bucket").isin(bucket))

    def build(self, files: DataFrame) -> Index:
        """files: file (long) and text; null is empty. Building again replaces the index."""
        rows = files.select(F.col("file").cast("long").alias("file"), F.coalesce("text", F.lit("")).alias("text"))
        self._write(rows.withColumn("bucket", _bucket(F.col("file"), self.buckets)), "texts")
        rows = self.table("texts").drop("bucket")  # as stored: what made the texts isn't done again
        rows.select("file", X.word_count(F.col("text")).alias("words")).write.mode("overwrite").parquet(f"{self.path}/files")
        own = F.transform(F.array_distinct(X.tokens(F.lower("text"))), lambda t: F.struct(t.alias("token"), F.lit(-1).alias("heading")))
        titles = F.flatten(F.transform(X.headings(F.col("text")), lambda h, i: F.transform(F.array_distinct(X.tokens(F.lower(h))), lambda t: F.struct(t.alias("token"), i.alias("heading")))))
        postings = rows.select("file", F.explode(F.concat(own, titles)).alias("p")).select("p.token", "file", "p.heading").withColumn("bucket", _bucket(F.col("token"), self.buckets))
        self._write(postings, "postings")
        self.table("postings").where("heading = -1").select("token").distinct().write.mode("overwrite").parquet(f"{self.path}/tokens")
        tokens = self.table("tokens")
        self._write(tokens.select("token", F.explode(_grams(F.col("token"))).alias("gram")).withColumn("bucket", _bucket(F.col("gram"), self.buckets)), "grams")
        return self

    def _asked(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets of some keys: a number of at most `buckets`."""
        return [r[0] for r in rows.select(_bucket(F.col(key), self.buckets)).distinct().collect()]

    def holding(self, parts: DataFrame) -> DataFrame:
        """id, file and heading (-1: in the text) wherever a token holds a part (id, part: the words of a book's terms)."""
        known = parts.where(F.length("part") >= GRAM).withColumn("gram", F.substring("part", 1, GRAM))
        tokens = self.table("grams", self._asked(known, "gram")).join(F.broadcast(known), "gram").where(F.contains("token", F.col("part"))).select("token", "id")
        tiny = parts.where(F.length("part") < GRAM)
        if not tiny.isEmpty():  # each token is looked at where it is, and only what holds a part goes on
            tokens = tokens.unionByName(self.table("tokens").join(F.broadcast(tiny), F.contains("token", F.col("part"))).select("token", "id"))
        # a file has many tokens that hold a part: its postings meet in one task before parts multiply them
        listed = stored(tokens.groupBy("token").agg(F.collect_set("id").alias("ids")), "tokens")
        found = self.table("postings", self._asked(listed, "token")).drop("bucket").join(listed, "token").select("file", "heading", "ids").repartition("file")
        return found.select(F.explode("ids").alias("id"), "file", "heading").distinct()

    def matches(self, terms: DataFrame) -> DataFrame:
        """term, file and heading (-1: the text) of all terms (a book's) in all files."""
        terms = terms.select("term").distinct().where("term <> ''").withColumn("parts", X.tokens(F.col("term")))
        each = terms.select("term", ((F.size("parts") == 1) & (F.col("term") == F.get("parts", 0))).alias("alone"), F.explode(F.array_distinct("parts")).alias("part"))
        parts = stored(each.select("part").distinct().withColumn("id", F.monotonically_increasing_id()), "parts")
        each = stored(each.join(parts, "part").select("term", "alone", "id"), "parts")
        found = stored(self.holding(parts), "found")
        single = found.join(F.broadcast(each.where("alone")), "id").select("term", "file", "heading")
        rest = each.where("NOT alone")
        if rest.isEmpty():
            return single
        size = rest.groupBy("term").agg(F.count("*").alias("k"))
        all_parts = found.where("heading = -1").join(F.broadcast(rest), "id").groupBy("term", "file").agg(F.count("*").alias("m")).join(F.broadcast(size), "term").where("m = k").select("term", "file")
        all_parts = stored(all_parts, "whole")
        if all_parts.isEmpty():
            return single
        texts = all_parts.join(self.table("texts", self._asked(all_parts, "file")), "file").where(F.contains(F.lower("text"), F.col("term")))
        inside = F.transform(X.headings(F.col("text")), lambda h, i: F.when(F.contains(F.lower(h), F.col("term")), i))
        return single.unionByName(texts.select("term", "file", F.explode(F.concat(F.array(F.lit(-1)), F.filter(inside, lambda i: i.isNotNull()))).alias("heading")))


def chapter_terms(chapters: DataFrame, lexicon: list[str]) -> DataFrame:
    """chapter, term and whether it is of the lexicon: words of topics, longer words of the title, and the lexicon's terms
    that hold one of those. Chapters (chapter, title, topics) are a book's."""
    words = F.array_distinct(F.concat(F.flatten(F.transform("topics", lambda t: X.tokens(F.lower(t)))), F.filter(X.tokens(F.lower("title")), lambda w: F.length(w) > 3)))
    lex = X.arr(lexicon) if lexicon else F.array().cast("array<string>")
    own = X.with_(words, lambda ws: F.array_distinct(F.concat(ws, F.filter(lex, lambda t: F.exists(ws, lambda w: F.contains(t, w))))))
    return chapters.select("chapter", F.explode(own).alias("term")).withColumn("listed", F.array_contains(lex, F.col("term")))


def slot_matches(chapters: DataFrame, slots: DataFrame) -> DataFrame:
    """chapter and slot: a slot's first part is in a word of the chapter (longer ones of its title, first ones of its
    topics), or such a word is in the slot. slots: the classifier's vocabulary, a short list."""
    words = F.array_distinct(F.concat(F.filter(X.tokens(F.lower(F.replace("title", F.lit(":"), F.lit(" ")))), lambda w: F.length(w) > 3), F.filter(F.transform("topics", lambda t: F.get(X.tokens(F.lower(t)), 0)), lambda w: w.isNotNull())))
    first = F.get(X.tokens(F.replace("slot", F.lit("-"), F.lit(" "))), 0)
    c = chapters.select("chapter", words.alias("words"))
    return c.join(F.broadcast(slots.select("slot").distinct().withColumn("first", first)), F.exists("words", lambda w: F.contains(F.col("slot"), w) | F.contains(w, F.col("first")))).select("chapter", "slot")


def ranked(index: Index, chapters: DataFrame, lexicon: list[str], classes: DataFrame) -> DataFrame:
    """chapter, rank, file, raw and score of the files that a chapter draws on. classes: file and slot, as classified."""
    terms = stored(chapter_terms(chapters, lexicon), "terms")
    # matches and slots are dealt by file before chapters multiply them: what a chapter has of a file is counted in place,
    # and meets the file's words there
    links = terms.select("term", "chapter", "listed", F.lit(False).alias("tag")).unionByName(slot_matches(chapters, classes).select(F.col("slot").alias("term"), "chapter", F.lit(False).alias("listed"), F.lit(True).alias("tag")))
    tags = classes.select(F.col("slot").alias("term"), F.col("file").cast("long").alias("file"), F.lit(None).cast("int").alias("heading"), F.lit(True).alias("tag"))
    hits = index.matches(terms).withColumn("tag", F.lit(False)).unionByName(tags).repartition("file").join(F.broadcast(links), ["term", "tag"])
    in_text = F.coalesce(F.col("heading") == -1, F.lit(False))
    heads = F.expr("bit_count(bit_or(CASE WHEN heading >= 0 THEN shiftleft(1, heading) END))")  # X.headings gives 25 at most
    counted = hits.groupBy("chapter", "file").agg(F.count_if(in_text).alias("n"), F.count_if(in_text & F.col("listed")).alias("listed"), F.coalesce(heads, F.lit(0)).alias("heads"), F.bool_or("tag").alias("tagged"))
    all_ = counted.withColumn("raw", F.col("listed") * 3 + F.col("heads") * 2 + F.least("n", F.lit(10)))
    all_ = all_.withColumn("raw", F.when(F.col("tagged"), F.floor(F.col("raw") * 1.5) + 2).otherwise(F.col("raw"))).where("raw > 0")
    scored = stored(all_.join(index.table("files"), "file").select("chapter", "file", "raw", F.round(F.col("raw") / F.sqrt(F.greatest("words", F.lit(1))), 9).alias("score")), "scored")
    best = scored.groupBy("chapter").agg(F.max("score").alias("best"))  # a row for each chapter
    order = Window.partitionBy("chapter").orderBy(F.desc("score"), "file")
    return scored.join(F.broadcast(best), "chapter").where(F.col("score") >= SHARE * F.col("best")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FILES).select("chapter", "rank", "file", "raw", "score")


def passages(index: Index, chapters: DataFrame, lexicon: list[str], classes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """chapter, rank, file, chunks (how many) and passage. Files give their paragraphs by the number of terms in them, in
    turn until the budget is used up; a chapter that finds nothing gets the beginnings of the three longest files."""
    top = stored(ranked(index, chapters, lexicon, classes), "top")
    terms = chapter_terms(chapters, lexicon).groupBy("chapter").agg(F.collect_list("term").alias("terms"))
    texts = top.join(index.table("texts", index._asked(top, "file")).drop("bucket"), "file").join(terms, "chapter")
    pieces = F.filter(F.transform(F.split("text", r"\n{2,}|(?=\n#{1,4}\s)"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: F.length(p) >= LEAST)
    counted = F.transform(pieces, lambda p, i: F.struct((-F.size(F.filter("terms", lambda t: F.contains(F.lower(p), t)))).alias("n"), i.alias("i"), p.alias("p")))
    # most terms first, then in order; more of them than the budget can hold never count
    best = F.slice(F.array_sort(F.filter(counted, lambda x: x["n"] < 0)), 1, budget // LEAST + 1)
    before = lambda c: F.transform(c, lambda x, i: F.aggregate(F.slice(c, 1, i), F.lit(0), lambda a, y: a + F.length(y["p"])))
    rows = texts.select("chapter", "rank", "file", best.alias("c")).where(F.size("c") > 0)
    rows = stored(rows.select("chapter", "rank", "file", F.transform("c", lambda x: x["p"]).alias("p"), before(F.col("c")).alias("before")), "chunks")
    files = rows.select("chapter", F.struct("rank", "before", F.aggregate("p", F.lit(0), lambda a, x: a + F.length(x)).alias("all")).alias("f")).groupBy("chapter").agg(F.array_sort(F.collect_list("f")).alias("f"))  # FILES at most

    def give(state: Column, f: Column) -> Column:
        left = state["left"]
        n = F.size(F.filter(f["before"], lambda b: b < left))
        spent = F.least(f["all"], left) + 2 * F.greatest(n - 1, F.lit(0))
        given = F.struct(f["rank"].alias("rank"), left.alias("left"), n.alias("n"))
        return F.when(left <= 0, state).otherwise(F.struct((left - spent).alias("left"), F.concat(state["out"], F.array(given)).alias("out")))

    start = F.struct(F.lit(budget).alias("left"), F.array().cast("array<struct<rank:int,left:int,n:int>>").alias("out"))
    dealt = files.select("chapter", F.explode(F.aggregate("f", start, give)["out"]).alias("g")).select("chapter", "g.rank", "g.left", "g.n")
    cut = F.transform(F.slice("p", 1, F.col("n")), lambda p, i: F.substring(p, 1, F.col("left") - F.get("before", i)))
    found = stored(rows.join(dealt, ["chapter", "rank"]).select("chapter", "rank", "file", F.col("n").alias("chunks"), F.array_join(cut, "\n\n").alias("passage")), "passages")
    empty = chapters.select("chapter").join(found.select("chapter").distinct(), "chapter", "left_anti")
    longest = index.table("files").orderBy(F.desc("words"), "file").limit(FALLBACK_FILES).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("words"), "file")))
    spare = longest.join(index.table("texts", index._asked(longest, "file")).drop("bucket"), "file").select("rank", "file", F.lit(1).alias("chunks"), F.substring("text", 1, FALLBACK_CHARS).alias("passage"))
    return found.unionByName(empty.join(F.broadcast(spare), F.lit(True)).select("chapter", "rank", "file", "chunks", "passage"))


#: Of a tool: paragraphs, their characters, the length of one at least and of its snippet.
TOOL_PASSAGES, TOOL_BUDGET, TOOL_LEAST, SNIPPET = 12, 6000, 80, 600


def tool_passages(files: DataFrame, tools: list[str], split: str = "\n\n") -> DataFrame:
    """tool, place, file, part and snippet: the first paragraphs (files: file, text; in order of file) that name a tool,
    without regard to case, until the characters are used up. Tools are a book's list, so a paragraph is matched where it
    is; only a tool's first TOOL_PASSAGES can count, and each task sends no more than so many."""
    parts = files.select("file", F.posexplode(F.split("text", split)).alias("part", "p")).where(F.length("p") > TOOL_LEAST)
    named = X.arr(tools) if tools else F.array().cast("array<string>")
    low = F.lower("p")
    hits = parts.select(F.explode(F.filter(named, lambda t: F.contains(low, F.lower(t)))).alias("tool"), "file", "part", F.substring(F.regexp_replace("p", r"^\s+|\s+$", ""), 1, SNIPPET).alias("snippet"))
    order = Window.partitionBy("tool").orderBy("file", "part")
    first = hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOOL_PASSAGES)
    spent = F.coalesce(F.sum(F.length("snippet")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("spent", spent).where(F.col("spent") < TOOL_BUDGET).select("tool", "place", "file", "part", "snippet")
