"""Passages for chapters through the stored index: files are documents in markdown, chapters come from the benchmark's items."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import LEXICON
from ..operators import vault_index
from ..registry import query
from ..sources.scratch import base_folder
from ..sources.tables import load
from .corpus import LEX, WORDS
from .sections import _MD, markdown

#: The classifier's label for each language: a short vocabulary.
SLOTS = {"en": "that-with", "fr": "elle-pour", "de": "sich-lich", "es": "para-mente"}


def inputs(spark: SparkSession, sf_dir: str) -> tuple[vault_index.Index, DataFrame, DataFrame]:
    """The index of all documents; chapters (an item's first three words are the title, the next three two topics); labels."""
    docs = load(spark, sf_dir, "documents")
    index = vault_index.Index(spark, f"{base_folder(spark)}/index-{uuid.uuid4().hex}")
    index.build(docs.select(F.col("doc_id").alias("file"), markdown(F.col("text")).alias("text")))
    w = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("chapter"), X.tokens(F.col("text")).alias("w"))
    title = F.array_join(F.slice("w", 1, 3), " ")
    chapters = w.select("chapter", title.alias("title"), F.array(F.get("w", 3), F.concat_ws(" ", F.get("w", 4), F.get("w", 5))).alias("topics"))
    slot = F.create_map(*[F.lit(x) for kv in SLOTS.items() for x in kv])[F.col("lang")]
    return index, chapters, docs.select(F.col("doc_id").alias("file"), slot.alias("slot")).where("slot IS NOT NULL")


_SLOT = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SLOTS.items()) + " END"
RANKED = f"""{_MD}, f AS (SELECT doc_id, lower(array_to_string(l, chr(10))) AS t, len({WORDS("array_to_string(l, chr(10))")}) AS words FROM md),
    hd AS (SELECT doc_id, unnest(list_slice(list_transform(list_filter(l, lambda x: regexp_matches(trim(x, ' '), '^#{{1,4}}\\s+\\S')), lambda x: lower(trim(regexp_replace(trim(x, ' '), '^#+', ''), ' '))), 1, 25)) AS h FROM md),
    b AS (SELECT item_id AS chapter, {WORDS("text")} AS w FROM benchmark),
    c AS (SELECT chapter, list_filter(list_transform(list_slice(w, 1, 3), lambda x: lower(x)), lambda x: length(x) > 3) AS title, list_transform(list_slice(w, 4, 6), lambda x: lower(x)) AS topics, list_transform([w[4], w[5]], lambda x: lower(x)) AS heads FROM b),
    own AS (SELECT chapter, unnest(list_concat(topics, title)) AS term FROM c),
    term AS (SELECT chapter, term FROM own UNION SELECT chapter, x FROM own, unnest({LEX}) AS u(x) WHERE contains(x, term)),
    hit AS (SELECT chapter, doc_id, count(*) AS n, count(*) FILTER (list_contains({LEX}, term)) AS listed FROM term JOIN f ON contains(t, term) GROUP BY chapter, doc_id),
    head AS (SELECT chapter, doc_id, count(*) AS heads FROM (SELECT DISTINCT chapter, hd.doc_id, h, i FROM (SELECT *, row_number() OVER () AS i FROM hd) hd JOIN term ON contains(h, term)) GROUP BY chapter, doc_id),
    slot AS (SELECT doc_id, {_SLOT} AS slot FROM documents),
    word AS (SELECT chapter, unnest(list_concat(title, heads)) AS w FROM c),
    tag AS (SELECT DISTINCT chapter, doc_id FROM slot JOIN word ON contains(slot, w) OR contains(w, split_part(slot, '-', 1))),
    raw AS (SELECT coalesce(h.chapter, d.chapter, g.chapter) AS chapter, coalesce(h.doc_id, d.doc_id, g.doc_id) AS doc_id, coalesce(listed, 0) * 3 + coalesce(heads, 0) * 2 + least(coalesce(n, 0), 10) AS raw, g.doc_id IS NOT NULL AS tagged
        FROM hit h FULL JOIN head d ON d.chapter = h.chapter AND d.doc_id = h.doc_id FULL JOIN tag g ON g.chapter = coalesce(h.chapter, d.chapter) AND g.doc_id = coalesce(h.doc_id, d.doc_id)),
    s AS (SELECT chapter, r.doc_id, CASE WHEN tagged THEN floor(raw * 1.5) + 2 ELSE raw END AS raw, round(CASE WHEN tagged THEN floor(raw * 1.5) + 2 ELSE raw END / sqrt(greatest(words, 1)), 9) AS score FROM raw r JOIN f ON f.doc_id = r.doc_id),
    r AS (SELECT *, max(score) OVER (PARTITION BY chapter) AS best FROM s),
    k AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, doc_id) AS rank FROM r WHERE score >= 0.25 * best)"""


@query(f"WITH {RANKED} SELECT chapter, CAST(rank AS INTEGER) AS rank, doc_id AS file, CAST(raw AS BIGINT) AS raw, round(score, 6) AS score FROM k WHERE rank <= 15")
def vault_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that each chapter draws on, found through the stored index."""
    index, chapters, classes = inputs(spark, sf_dir)
    return vault_index.ranked(index, chapters, LEXICON, classes).select("chapter", "rank", "file", F.col("raw").cast("long").alias("raw"), F.round("score", 6).alias("score"))


@query()
def vault_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of each chapter, within its budget."""
    index, chapters, classes = inputs(spark, sf_dir)
    return vault_index.passages(index, chapters, LEXICON, classes).select("chapter", "rank", "file", "chunks", F.md5("passage").alias("digest"))


@query(f"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), p AS (SELECT doc_id, i - 1 AS part, l[i] AS p FROM l, unnest(range(1, len(l) + 1)) AS u(i) WHERE length(l[i]) > 80),
    h AS (SELECT tool, doc_id, part, substr(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), 1, 600) AS s FROM p, unnest({LEX}) AS u(tool) WHERE contains(lower(p), tool)),
    r AS (SELECT *, row_number() OVER o AS place, coalesce(sum(length(s)) OVER (PARTITION BY tool ORDER BY doc_id, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM h WINDOW o AS (PARTITION BY tool ORDER BY doc_id, part))
    SELECT tool, CAST(place AS INTEGER) AS place, doc_id AS file, CAST(part AS INTEGER) AS part, md5(s) AS digest FROM r WHERE place <= 12 AND spent < 6000""")
def tool_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of documents that name each tool, here the lexicon's terms."""
    files = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), "text")
    return vault_index.tool_passages(files, LEXICON, "\n").select("tool", "place", "file", "part", F.md5("snippet").alias("digest"))
