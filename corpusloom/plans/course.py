"""Course material over documents: a source is a book, its documents are the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lists import LEXICON, OUTLINE
from ..functions.records import MEASURE, VERBS
from ..operators import course, sections
from ..registry import query
from ..sources.scratch import stored
from ..sources.tables import load
from .corpus import DENSITY, LEX, WORDS

_TERMS = "[" + ", ".join(f"'{t}'" for t in sorted({t.lower() for t in LEXICON})) + "]"
_VERBS = f"\\b({'|'.join(VERBS)})\\b"
_POOL = f"""r AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY octet_length(encode(text)) DESC, doc_id) AS place FROM documents),
    f AS (SELECT doc_id, source, place, {WORDS("text")} AS w FROM r WHERE place <= 80 AND {DENSITY("substr(text, 1, 20000)")} >= 3),
    c AS (SELECT doc_id, source, place, i AS chunk, array_to_string(list_slice(w, i * 300 + 1, i * 300 + 300), ' ') AS t FROM f, unnest(range(0, CAST(ceil(len(w) / 300) AS BIGINT))) AS u(i)),
    l AS (SELECT doc_id, source, place, chunk, string_split(regexp_replace(t, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS l FROM c),
    s AS (SELECT doc_id, source, place, chunk, j, l[j] AS s, regexp_extract_all(lower(l[j]), '{_VERBS}', 1) AS verbs, list_filter({_TERMS}, lambda t: contains(lower(l[j]), t)) AS found FROM l, unnest(range(1, len(l) + 1)) AS u(j)),
    k AS (SELECT source AS book, place, doc_id AS file, chunk, j, substr(trim(s, ' '), 1, 150) AS task, list_slice(list_sort(list_distinct(list_concat(list_slice(verbs, 1, 3), list_slice(found, 1, 2)))), 1, 5) AS tools
        FROM s WHERE length(trim(s, ' ')) >= 20 AND CAST(len(verbs) > 0 AS INTEGER) + CAST(len(found) > 0 AS INTEGER) + CAST(regexp_matches(s, '{MEASURE}') AS INTEGER) >= 2),
    pool AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY book, task ORDER BY place, chunk, j) = 1),
    tools AS (SELECT book, list_sort(list_distinct(flatten(list(tools)))) AS tools FROM pool GROUP BY book)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(F.col("source").alias("book"), F.col("doc_id").alias("file"), "text")


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return course.practice_pool(files(spark, sf_dir), LEXICON)


@query(f"WITH {_POOL} SELECT book, file, task, array_to_string(tools, ',') AS tools FROM pool")
def practice_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The practice sentences of each source's largest dense documents, each once."""
    return pool(spark, sf_dir).select("book", "file", "task", F.array_join("tools", ",").alias("tools"))


def _chapter_sql(n: int, title: str, topics: list[str] | None, keywords: list[str]) -> str:
    mine = [t for t in LEXICON if any(k in t for k in keywords)][:6]
    listed = lambda v: "CAST([" + ", ".join(f"'{t}'" for t in v) + "] AS VARCHAR[])"
    head = listed(topics) if topics else "list_slice(coalesce(tools, []), 1, 8)"
    name = f"'{title}' || upper(book[1]) || lower(book[2:])" if title.endswith(" ") else f"'{title}'"
    return f"SELECT book, {n} AS n, {name} AS title, list_concat({head}, {listed(mine)}) AS base FROM b"


_OUTLINE = f"""b AS (SELECT book, tools FROM (SELECT DISTINCT source AS book FROM documents) LEFT JOIN tools USING (book)),
    o AS ({" UNION ALL ".join(_chapter_sql(i + 1, *c) for i, c in enumerate(OUTLINE))}),
    outline AS (SELECT book, n, title, list_concat(base, list_slice(list_filter({LEX}, lambda t: len(list_filter(list_slice(base, 1, 4), lambda k: contains(t, k))) > 0), 1, 4)) AS topics, list_slice(base, 1, 5) AS keys FROM o)"""


def outline(spark: SparkSession, sf_dir: str, tasks: DataFrame) -> DataFrame:
    books = load(spark, sf_dir, "documents").select(F.col("source").alias("book")).distinct()
    return course.outline(books.join(course.tools(tasks), "book", "left"), LEXICON)


@query(f"WITH {_POOL}, {_OUTLINE} SELECT book, CAST(n AS INTEGER) AS n, title, array_to_string(topics, ',') AS topics FROM outline")
def course_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of each source's book, made without a model."""
    return outline(spark, sf_dir, pool(spark, sf_dir)).select("book", "n", "title", F.array_join("topics", ",").alias("topics"))


@query(f"WITH {_POOL}, {_OUTLINE} SELECT book, CAST(n AS INTEGER) AS n, task FROM pool JOIN outline USING (book) WHERE len(list_filter(keys, lambda k: contains(lower(task), k))) > 0")
def course_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks that each chapter of an outline refers to."""
    tasks = stored(pool(spark, sf_dir), "tasks")
    return course.references(outline(spark, sf_dir, tasks), tasks)


@query(f"""WITH {_POOL}, i AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY place, chunk, j) AS i FROM pool),
    t AS (SELECT book, string_agg('- ' || task, chr(10) ORDER BY i) AS tasks FROM i WHERE i <= 20 GROUP BY book)
    SELECT book, array_to_string(list_filter(tools, lambda x: length(x) > 2), ',') AS tools,
    md5('Tasks covered:' || chr(10) || tasks || CASE WHEN len(tools) > 0 THEN chr(10) || chr(10) || 'Tools/materials mentioned:' || chr(10) || array_to_string(list_transform(list_slice(tools, 1, 20), lambda x: '- ' || x), chr(10)) ELSE '' END) AS digest FROM t JOIN tools USING (book)""")
def course_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book's tools, and the summary of its tasks."""
    return course.summary(stored(pool(spark, sf_dir), "tasks")).select("book", F.array_join("tools", ",").alias("tools"), F.md5("text").alias("digest"))


@query(f"""WITH {_POOL}, a AS (SELECT DISTINCT book, array_to_string(list_slice({WORDS("task")}, 1, 4), ' ') AS area FROM pool)
    SELECT book, area, '{course.SEARCH}' || replace(url_encode(area), '%20', '+') AS url FROM a""")
def course_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search for each skill area of each book."""
    return course.searches(pool(spark, sf_dir))


#: Words that stand for tools foreign to the crafts of the given documents.
STRAY = {"thatworking": ["shat", "elle", "that"], "leather": ["b sich b", "is"]}
_STRAY = "(?i)(?:^|[^\\p{L}\\p{N}_])(?:shat|elle|that)(?:$|[^\\p{L}\\p{N}_])"


@query(f"""WITH p AS (SELECT doc_id, text, list_transform(regexp_extract_all(text, '[^.!?\\n]*[.!?\\n]|[^.!?\\n]+$'), lambda s: CASE WHEN regexp_matches(s, '[.!?]$') AND regexp_matches(s, '{_STRAY}') THEN NULL ELSE s END) AS l FROM documents),
    s AS (SELECT doc_id, text, len(list_filter(l, lambda s: s IS NULL)) AS n, array_to_string(list_transform(l, lambda s: coalesce(s, ' ')), '') AS t FROM p)
    SELECT doc_id, CAST(n AS INTEGER) AS stripped, md5(CASE WHEN n = 0 THEN text ELSE regexp_replace(regexp_replace(regexp_replace(t, ' {{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') END) AS digest FROM s""")
def foreign_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the sentences that name stray tools."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    return sections.without_foreign(d, "that", STRAY).select("doc_id", "stripped", F.md5("text").alias("digest"))


@query("""WITH c AS (SELECT conv_id AS chapter, turn AS claim_id, text, CASE WHEN length(text) % 3 = 0 THEN 'flagged' WHEN length(text) % 3 = 1 THEN 'verified' ELSE 'tentative' END AS confidence FROM conversations WHERE turn > 0),
    g AS (SELECT chapter, count(*) AS n, count(*) FILTER (confidence = 'verified') AS v, count(*) FILTER (confidence = 'flagged') AS k, string_agg('- *' || text || '*', chr(10) ORDER BY claim_id, text) FILTER (confidence = 'flagged') AS l FROM c GROUP BY chapter),
    f AS (SELECT conv_id AS chapter, string_agg(DISTINCT '- `' || role || '`', chr(10) ORDER BY '- `' || role || '`') AS files FROM conversations GROUP BY conv_id)
    SELECT conv_id AS chapter, md5(text || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '### Chapter Sources & Verification' || chr(10)
        || CASE WHEN files IS NULL THEN '' ELSE chr(10) || '**Source files used:**' || chr(10) || chr(10) || files || chr(10) END
        || CASE WHEN coalesce(k, 0) = 0 THEN '' ELSE chr(10) || chr(10) || '**⚠ ' || k || ' claim(s) could not be verified against source material:**' || chr(10) || chr(10) || l || chr(10) || chr(10)
            || '*These claims may be accurate but were not found in the collected source files. Verify independently before relying on them.*' END
        || CASE WHEN coalesce(v, 0) = 0 THEN '' ELSE chr(10) || chr(10) || '*' || v || '/' || n || ' claims cross-referenced to source material.*' END) AS digest
    FROM conversations LEFT JOIN f ON f.chapter = conv_id LEFT JOIN g ON g.chapter = conv_id WHERE turn = 0""")
def sources_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chapters: the first turn is the text, the others are its claims, roles are its files."""
    c = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chapter"), F.col("turn").alias("claim_id"), "role", "text")
    third = F.length("text") % 3
    claims = c.where("claim_id > 0").withColumn("confidence", F.when(third == 0, "flagged").when(third == 1, "verified").otherwise("tentative"))
    out = sections.with_sources(c.where("claim_id = 0"), claims, c.select("chapter", F.col("role").alias("file")))
    return out.select("chapter", F.md5("text").alias("digest"))
