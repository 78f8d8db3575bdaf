"""Books in markdown, made of documents: a document is a chapter whose first line is its title and whose short lines are headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import PEDAGOGY_HEADINGS
from ..operators import sections
from ..registry import query
from ..sources.tables import load
from .corpus import WORDS

SHORT_LINE = 40
TOPIC = "thatworking"
_MD = f"""md AS (SELECT doc_id, source, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i = 1 THEN '## ' || x WHEN length(x) BETWEEN 1 AND {SHORT_LINE - 1} THEN '### ' || x ELSE x END) AS l FROM documents)"""
_EXEMPT = "[" + ", ".join(f"'{h}'" for h in PEDAGOGY_HEADINGS) + "]"


def markdown(text: Column) -> Column:
    one = lambda x, i: F.when(i == 0, F.concat(F.lit("## "), x)).when(F.length(x).between(1, SHORT_LINE - 1), F.concat(F.lit("### "), x)).otherwise(x)
    return F.array_join(F.transform(F.split(text, "\n"), one), "\n")


def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a book, its documents are the chapters in order of doc_id."""
    return load(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("chapter"), markdown(F.col("text")).alias("text"))


@query(f"""WITH {_MD}, h AS (SELECT doc_id, list_transform(list_filter(l, lambda x: regexp_matches(trim(x, ' '), '^#{{1,4}}\\s+\\S')), lambda x: trim(regexp_replace(trim(x, ' '), '^#+', ''), ' ')) AS h FROM md)
    SELECT doc_id, CAST(len(list_slice(h, 1, 25)) AS INTEGER) AS n, md5(array_to_string(list_slice(h, 1, 25), chr(10))) AS digest FROM h""")
def heading_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 headings of each document."""
    h = chapters(spark, sf_dir).select(F.col("chapter").alias("doc_id"), X.headings(F.col("text")).alias("h"))
    return h.select("doc_id", F.size("h").alias("n"), F.md5(F.array_join("h", "\n")).alias("digest"))


_TITLES = "SELECT doc_id, i - 1 AS line, l[i] AS x FROM md, unnest(range(1, len(l) + 1)) AS u(i)"


@query(f"""WITH md AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN length(x) BETWEEN 1 AND {SHORT_LINE - 1} THEN '## ' || i || '. ' || x ELSE x END) AS l FROM documents),
    h AS (SELECT doc_id, min(line) AS start, lower(trim(regexp_replace(x, '^## \\d+\\. ', ''), ' ')) AS norm FROM ({_TITLES}) WHERE x LIKE '## %' GROUP BY doc_id, norm),
    t AS (SELECT DISTINCT d.doc_id, x AS title FROM documents d, unnest(string_split(text, chr(10))) AS u(x) WHERE length(x) BETWEEN 1 AND {SHORT_LINE - 1} AND length(x) % 3 <> 0),
    f AS (SELECT t.doc_id, title, start, lead(start) OVER (PARTITION BY t.doc_id ORDER BY start, title) AS stop FROM t JOIN h ON h.doc_id = t.doc_id AND h.norm = lower(trim(title, ' '))),
    c AS (SELECT f.doc_id, title, array_to_string(list_slice(l, start + 1, coalesce(stop, len(l))), chr(10)) AS content FROM f JOIN md ON md.doc_id = f.doc_id)
    SELECT doc_id, title, CAST(len({WORDS('content')}) AS INTEGER) AS words, md5(content) AS digest FROM c""")
def chapter_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a book whose short lines are numbered headings; some of those are its chapters' titles. A chapter
    goes from its first heading to that of the next."""
    d = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), F.split("text", "\n").alias("l"))
    short = lambda x: F.length(x).between(1, SHORT_LINE - 1)
    books = d.select("book", F.array_join(F.transform("l", lambda x, i: F.when(short(x), F.concat(F.lit("## "), (i + 1).cast("string"), F.lit(". "), x)).otherwise(x)), "\n").alias("text"))
    titles = d.select("book", F.explode(F.array_distinct(F.filter("l", lambda x: short(x) & (F.length(x) % 3 != 0)))).alias("title")).withColumn("n", F.col("title"))
    c = sections.checks(sections.slices(books, titles))
    return c.select(F.col("book").alias("doc_id"), "title", "words", F.md5("content").alias("digest"))


@query(f"""WITH {_MD}, x AS ({_TITLES}),
    h AS (SELECT doc_id, line, trim(regexp_replace(lower(trim(regexp_replace(x, '^#+\\s+', ''), ' ')), '^\\d+[.)]\\s*', ''), ' ') AS norm FROM x WHERE regexp_matches(x, '^#{{2,4}}\\s+\\S')),
    r AS (SELECT h.doc_id, line, row_number() OVER (PARTITION BY source, norm ORDER BY h.doc_id, line) > 1 AND NOT list_contains({_EXEMPT}, norm) AS gone FROM h JOIN md USING (doc_id)),
    s AS (SELECT x.doc_id, x.line, x, coalesce((last_value(gone IGNORE NULLS) OVER (PARTITION BY x.doc_id ORDER BY x.line)), false) AS gone FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.line = x.line),
    n AS (SELECT doc_id, count(*) AS trimmed FROM r WHERE gone GROUP BY doc_id),
    k AS (SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone), '') AS t FROM s GROUP BY doc_id)
    SELECT k.doc_id, CAST(coalesce(trimmed, 0) AS INTEGER) AS trimmed, md5(CASE WHEN trimmed IS NULL THEN t ELSE regexp_replace(regexp_replace(t, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') END) AS digest FROM k LEFT JOIN n ON n.doc_id = k.doc_id""")
def section_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters without the sections whose headings their book had before."""
    return sections.without_repeats(chapters(spark, sf_dir)).select(F.col("chapter").alias("doc_id"), "trimmed", F.md5("text").alias("digest"))


_HITS = " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{r}', ''))) // {len(r)}" for r in sections.chapter_roots(TOPIC))


@query(f"SELECT doc_id, ({_HITS}) / (greatest(len({WORDS('text')}), 1) / 100) < 0.5 AS drifted, CAST(CASE WHEN ({_HITS}) / (greatest(len({WORDS('text')}), 1) / 100) < 0.5 THEN 2 ELSE 0 END AS INTEGER) AS missing FROM documents")
def topic_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters that left their topic, and how many of their expected topics (language and source) are missing for that."""
    c = load(spark, sf_dir, "documents").select("doc_id", "text", F.array("lang", "source").alias("topics"))
    return sections.on_topic(c, TOPIC).select("doc_id", "drifted", F.size("missing").alias("missing"))
