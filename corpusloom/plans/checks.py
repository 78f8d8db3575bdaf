"""Links and citations, verification of claims by texts, practice sentences and probes, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions import records as R
from ..functions import text as X
from ..functions.lists import LEXICON
from ..operators import probes, verify
from ..registry import query
from ..sources.tables import load, vault
from .quality import node_gate

TOOLS = ["that", "with", "elle", "pour"]


def _changed(spark: SparkSession, sf_dir: str, fold) -> DataFrame:
    out = load(spark, sf_dir, "documents").select("doc_id", fold.alias("r")).where("r.n > 0")
    return out.select("doc_id", "r.n", F.md5("r.text").alias("digest"))


@query()
def chapter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, L.link_chapters_udf("text"))


@query()
def tool_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed(spark, sf_dir, L.cite_tools_udf(F.col("text"), X.arr(TOOLS)))


@query()
def claim_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of benchmark as claims, turns of conversations as claim records, documents as files."""
    claims = load(spark, sf_dir, "benchmark").where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("claim_id"), "text")
    records = load(spark, sf_dir, "conversations").select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("source"), "text")
    v = vault(spark, sf_dir).select(F.col("doc_id").cast("string").alias("source"), "text", "low_trust")
    return verify.verify(claims, records, v.select("source", "text"), v.where("low_trust").select("source"))


_terms = "[" + ", ".join(repr(t) for t in sorted(LEXICON)) + "]"
_verbs = "|".join(R.VERBS)


@query(f"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS s FROM documents),
f AS (SELECT doc_id, length(trim(s, ' ')) AS n, CAST(regexp_matches(lower(s), '\\b(?:{_verbs})\\b') AS INT) + CAST(len(list_filter({_terms}, lambda t: contains(lower(s), t))) > 0 AS INT) + CAST(regexp_matches(s, '{R.MEASURE}') AS INT) AS signs FROM s)
SELECT doc_id, CAST(count(*) AS BIGINT) AS tasks FROM f WHERE n >= 20 AND signs >= 2 GROUP BY doc_id""")
def practice_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of a document that tell what to do."""
    d = load(spark, sf_dir, "documents").select("doc_id", F.size(R.practice(F.col("text"), LEXICON)).cast("bigint").alias("tasks"))
    return d.where("tasks > 0").groupBy("doc_id").agg(F.sum("tasks").alias("tasks"))


def _gate_sql() -> str:
    from ..registry import ORACLE

    return f"""WITH g AS ({ORACLE["node_gate"]}), t AS (SELECT reason IN ('topic-root-match', 'lexicon-match') AS ok, p_size % 2 = 0 AS on_topic FROM g JOIN part ON p_partkey = node),
m AS (SELECT count(*) FILTER (ok AND on_topic) AS on_accepted, count(*) FILTER (NOT ok AND on_topic) AS on_rejected, count(*) FILTER (NOT ok AND NOT on_topic) AS off_rejected, count(*) FILTER (ok AND NOT on_topic) AS off_accepted FROM t)
SELECT 'drift-gate-precision' AS probe, CASE WHEN off_accepted > 0 OR on_rejected > 1 THEN 'FAIL' WHEN on_rejected = 0 THEN 'PASS' ELSE 'INCONCLUSIVE' END AS verdict, * FROM m"""


@query(_gate_sql())
def drift_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node gate judged by a stand-in truth (parts of even size are on the topic)."""
    truth = load(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("node"), (F.col("p_size") % 2 == 0).alias("on_topic"))
    g = node_gate(spark, sf_dir).select("node", F.col("reason").isin("topic-root-match", "lexicon-match").alias("allowed"))
    return probes.drift_gate_precision(g.join(truth, "node"))
