"""Terms: bold terms, acronyms, n-grams and their canonical forms, index and first mentions."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import IDLE_WORDS
from ..operators import ngrams, terminology
from ..registry import query
from ..sources.tables import load

BOLD = "b AS (SELECT doc_id, lower(trim(unnest(regexp_extract_all(text, '\\*\\*([^*\\n]{2,60})\\*\\*', 1)), ' ')) AS term FROM documents)"


def bold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\*\*([^*\n]{2,60})\*\*"), 1)).alias("term")).select("doc_id", F.lower(F.btrim("term")).alias("term"))


@query(f"WITH {BOLD} SELECT term, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first FROM b GROUP BY term")
def bold_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bold(spark, sf_dir).groupBy("term").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query("WITH a AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z]{3,6}')) AS acronym FROM documents) SELECT acronym, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first FROM a GROUP BY acronym")
def acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([A-Z]{3,6})"), 1)).alias("acronym"))
    return a.groupBy("acronym").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


NGRAM = "t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z-]{2,}') AS w FROM documents), g AS (SELECT w[i] || ' ' || w[i + 1] AS term FROM (SELECT w, unnest(range(1, len(w))) AS i FROM t)), c AS (SELECT term, count(*) AS n FROM g WHERE length(term) >= 10 GROUP BY term HAVING count(*) >= 2)"


def _long_pair(words: ngrams.Vocabulary, columns: list) -> np.ndarray:
    """Ten characters, the blank included."""
    size = pc.binary_length(words.words).to_numpy()
    return sum(size[c] for c in columns) >= 9 if len(columns) == 2 else np.zeros(len(columns[0]), bool)


def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of neighbouring words, across sentences and lines, that occur twice or more."""
    found = ngrams.frequent(load(spark, sf_dir, "documents"), F.lit(""), F.col("text"), _long_pair, lambda w: [w], bool, bool, 2, 2, True)
    return found.where("n >= 2").select(F.col("phrase").alias("term"), "n")


@query(f"WITH {NGRAM} SELECT term, CAST(n AS BIGINT) AS n FROM c")
def term_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigrams(spark, sf_dir)


def _lemma(w: str) -> str:
    return f"CASE WHEN length({w}) < 5 THEN {w} WHEN {w} LIKE '%ing' THEN {w}[:-4] WHEN {w} LIKE '%ed' THEN {w}[:-3] WHEN {w} LIKE '%ies' THEN {w}[:-4] || 'y' WHEN {w} LIKE '%es' THEN {w}[:-3] WHEN {w} LIKE '%s' THEN {w}[:-2] ELSE {w} END"


@query(f"""WITH {NGRAM}, k AS (SELECT term, n, array_to_string(list_transform(list_filter(string_split(replace(term, '-', ' '), ' '), lambda w: true), lambda w: {_lemma('w')}), ' ') AS key FROM c),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, length(term), term) AS i, sum(n) OVER (PARTITION BY key) AS total, count(*) OVER (PARTITION BY key) AS variants, lead(n) OVER (PARTITION BY key ORDER BY n DESC, length(term), term) AS second FROM k)
    SELECT key, term AS canonical, CAST(total AS BIGINT) AS total FROM r WHERE i = 1 AND variants >= 2 AND total >= 6 AND n >= 2 * second""")
def canonical_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group of variants' most frequent form, where it dominates: six uses or more, twice the runner-up."""
    key = F.array_join(F.transform(F.split(F.replace("term", F.lit("-"), F.lit(" ")), " "), X.lemma), " ")
    w = Window.partitionBy("key").orderBy(F.desc("n"), F.length("term"), "term")
    whole = Window.partitionBy("key")
    r = bigrams(spark, sf_dir).withColumn("key", key).withColumns({"i": F.row_number().over(w), "second": F.lead("n").over(w), "total": F.sum("n").over(whole), "variants": F.count("*").over(whole)})
    return r.where("i = 1 AND variants >= 2 AND total >= 6 AND n >= 2 * second").select("key", F.col("term").alias("canonical"), "total")


@query(f"WITH {BOLD}, d AS (SELECT DISTINCT term, doc_id FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY doc_id) AS i FROM d) SELECT term, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS chapters FROM r WHERE i <= 5 GROUP BY term")
def index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five chapters of each term."""
    r = bold(spark, sf_dir).distinct().withColumn("i", F.row_number().over(Window.partitionBy("term").orderBy("doc_id"))).where("i <= 5")
    return r.groupBy("term").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("chapters"))


FIRST = ["that", "with", "pour", "sich", "para"]


@query("WITH t AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in FIRST) + "]) AS term), m AS (SELECT term, lang, doc_id FROM documents, t WHERE contains(' ' || regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || term || ' ')) SELECT term, lang, min(doc_id) AS first FROM m GROUP BY ALL")
def first_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    m = d.select("lang", "doc_id", F.explode(F.filter(X.arr(FIRST), lambda t: X.mentions(F.col("text"), t))).alias("term"))
    return m.groupBy("term", "lang").agg(F.min("doc_id").alias("first"))


_IDLE = "[" + ", ".join(f"'{w}'" for w in IDLE_WORDS) + "]"
_SAYS = lambda w: f"len(list_filter({w}, lambda x: NOT list_contains({_IDLE}, x))) >= 2 AND len(list_filter({w}, lambda x: NOT list_contains({_IDLE}, x) AND length(x) > 4)) > 0"
_KIND = "CASE WHEN {0} LIKE '%ing' THEN 'gerund' WHEN {0} LIKE '%ed' THEN 'past' WHEN {0} LIKE '%s' AND length({0}) > 4 AND {0} NOT LIKE '%ss' THEN 'plural' ELSE 'base' END"
TERM_MAP = f"""t AS (SELECT lang AS book, regexp_extract_all(lower(text), '[a-z][a-z-]{{2,}}') AS w FROM documents),
    one AS (SELECT book, unnest(w) AS phrase FROM t),
    g AS (SELECT book, phrase, string_split(phrase, '-') AS w FROM one WHERE contains(phrase, '-') AND len(string_split(phrase, '-')) BETWEEN 2 AND 3 AND len(list_filter(string_split(phrase, '-'), lambda p: length(p) < 3)) = 0
        UNION ALL SELECT book, array_to_string(w, ' '), w FROM (SELECT book, unnest(list_transform(range(1, len(w)), lambda i: list_slice(w, i, i + 1))) AS w FROM t WHERE len(w) >= 2)
        UNION ALL SELECT book, array_to_string(w, ' '), w FROM (SELECT book, unnest(list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2))) AS w FROM t WHERE len(w) >= 3)),
    c AS (SELECT book, phrase, count(*) AS n FROM g WHERE {_SAYS("w")} GROUP BY book, phrase),
    p AS (SELECT *, list_filter(string_split_regex(phrase, '[- ]+'), lambda w: w <> '') AS ws, string_split_regex(phrase, '[ -]') AS ends FROM c),
    k AS (SELECT book, phrase, n, array_to_string(list_transform(ws, lambda w: {_lemma("w")}), ' ') AS key, {_KIND.format("ends[len(ends)]")} AS kind FROM p),
    r AS (SELECT *, row_number() OVER o AS i, first_value(phrase) OVER o AS best, first_value(kind) OVER o AS best_kind, first_value(n) OVER o AS top, sum(n) OVER (PARTITION BY book, key) AS total, nth_value(n, 2) OVER (PARTITION BY book, key ORDER BY n DESC, length(phrase), phrase ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second
        FROM k WINDOW o AS (PARTITION BY book, key ORDER BY n DESC, length(phrase), phrase)),
    terms AS (SELECT book, phrase AS variant, best, n FROM r WHERE i > 1 AND total >= 6 AND top >= 2 * second AND kind = best_kind)"""


def term_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language is a book, its documents are the chapters."""
    return terminology.preferred(terminology.variants(load(spark, sf_dir, "documents").select(F.col("lang").alias("book"), "text")))


@query(f"WITH {TERM_MAP} SELECT book, variant, best, CAST(n AS BIGINT) AS n FROM terms")
def term_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What gives way to what in each book."""
    return term_table(spark, sf_dir)


@query()
def term_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which the variants of a phrase have given way to the dominant form of their language: what changed, and a digest."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("book"))
    return terminology.harmonised(docs, term_table(spark, sf_dir), "doc_id").where("replacements > 0").select("doc_id", "replacements", F.md5("text").alias("digest"))
