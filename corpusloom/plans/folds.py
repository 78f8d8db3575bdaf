"""Markdown folds applied to all documents: one row a document whose text a fold changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import text as X
from ..functions.lists import LEXICON
from ..registry import query
from ..sources.tables import load


def _changed(spark: SparkSession, sf_dir: str, fold) -> DataFrame:
    out = load(spark, sf_dir, "documents").select("doc_id", fold.alias("r")).where("r.n > 0")
    return out.select("doc_id", "r.n", F.md5("r.text").alias("digest"))


@query()
def table_reformat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, M.tables_to_lists_udf("text"))


@query()
def glossary_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to a glossary of fixed terms."""
    return _changed(spark, sf_dir, M.link_terms_udf(F.col("text"), X.arr(LEXICON)))


@query()
def acronym_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, M.expand_acronyms_udf("text"))


CLAIMS = ["The sole takes leather of 8 oz", "Soak the hide for 12 hours", "Keep it below 40 psi"]


@query()
def unsupported_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose sentences to a chapter's claims, or have names that those don't; a chapter's claims are a bounded list."""
    out = load(spark, sf_dir, "documents").select("doc_id", M.drop_unsupported_udf(F.col("text"), X.arr(CLAIMS)).alias("r")).where("r.dropped > 0 OR r.names > 0")
    return out.select("doc_id", "r.seen", "r.dropped", "r.names", F.md5("r.text").alias("digest"))


_trim = "regexp_replace(p, '^\\s+|\\s+$', '', 'g')"
_count = lambda marks: f"len(regexp_extract_all({_trim}, '(?i)" + "|".join(marks) + "'))"


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p FROM documents)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM p WHERE length({_trim}) >= 80 AND NOT regexp_matches({_trim}, '^(?:[#*>|-]|```)') AND NOT regexp_matches({_trim}, '(?:Historical|Modern) practice:') AND {_count(M.HISTORICAL)} >= 2 AND {_count(M.MODERN)} = 0 GROUP BY doc_id""")
def era_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs flagged as historical practice, by document."""
    mark = "Historical practice:"
    count = lambda c: (F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)
    d = load(spark, sf_dir, "documents").select("doc_id", (count(M.flag_era(F.col("text"))) - count(F.col("text"))).cast("bigint").alias("n"))
    return d.groupBy("doc_id").agg(F.sum("n").alias("n")).where("n > 0")
