"""Quality reports, run health, work frontier and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import OFF_TOPIC, SOURCES
from ..registry import query
from ..sources.tables import load, source_config, vault
from .corpus import CONFIG, VAULT

LAB = "SELECT source, count(*) AS n, count(*) FILTER (quality = 1 AND toxic = 0) AS verified, count(*) FILTER (quality = 1 AND toxic = 1) AS tentative, count(*) FILTER (quality = 0) AS flagged, count(*) FILTER (n_chars < 500) AS thin FROM documents JOIN labels USING (doc_id) GROUP BY source"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    q, t = F.col("quality") == 1, F.col("toxic") == 1
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count_if(q & ~t).alias("verified"), F.count_if(q & t).alias("tentative"), F.count_if(~q).alias("flagged"), F.count_if(F.col("n_chars") < 500).alias("thin"))


@query(f"WITH s AS ({LAB}) SELECT source, CASE WHEN n = 0 THEN 1.0 ELSE round((verified + 0.5 * tentative) / n, 6) END AS score FROM s")
def fact_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("source", F.when(F.col("n") == 0, 1.0).otherwise(F.round((F.col("verified") + 0.5 * F.col("tentative")) / F.col("n"), 6)).alias("score"))


COMPOSITE = f"s AS ({LAB}), c AS (SELECT *, (verified + 0.5 * tentative) / n AS facts, 1 - flagged / n AS pedagogy, greatest(0.0, 1 - 0.1 * flagged) AS coherence, 1 - thin / n AS full_ FROM s), r AS (SELECT *, 0.35 * facts + 0.30 * pedagogy + 0.20 * coherence + 0.15 * full_ AS score FROM c)"


def composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    r = labelled(spark, sf_dir).withColumns({"facts": (c("verified") + 0.5 * c("tentative")) / c("n"), "pedagogy": 1 - c("flagged") / c("n"), "coherence": F.greatest(F.lit(0.0), 1 - 0.1 * c("flagged")), "full_": 1 - c("thin") / c("n")})
    return r.withColumn("score", 0.35 * c("facts") + 0.30 * c("pedagogy") + 0.20 * c("coherence") + 0.15 * c("full_"))


@query(f"WITH {COMPOSITE} SELECT source, round(score, 6) AS score, CASE WHEN score >= 0.74 THEN 'usable' WHEN score >= 0.70 THEN 'neutral' ELSE 'weak' END AS tag FROM r")
def quality_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite(spark, sf_dir).select("source", F.round("score", 6).alias("score"), F.when(F.col("score") >= 0.74, "usable").when(F.col("score") >= 0.70, "neutral").otherwise("weak").alias("tag"))


@query(f"WITH {COMPOSITE} SELECT source, array_to_string(list_filter([CASE WHEN facts < 0.70 THEN 'facts' END, CASE WHEN pedagogy < 0.80 THEN 'pedagogy' END, CASE WHEN flagged > 2 THEN 'duplicates' END, CASE WHEN thin > greatest(1, n // 4) THEN 'thin' END, CASE WHEN n < 5 THEN 'chapters' END], lambda x: x IS NOT NULL), ',') AS reasons FROM r")
def usability_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rules = [(c("facts") < 0.70, "facts"), (c("pedagogy") < 0.80, "pedagogy"), (c("flagged") > 2, "duplicates"), (c("thin") > F.greatest(F.lit(1), F.floor(c("n") / 4)), "thin"), (c("n") < 5, "chapters")]
    return composite(spark, sf_dir).select("source", F.array_join(F.array_compact(F.array(*[F.when(t, n) for t, n in rules])), ",").alias("reasons"))


@query(f"WITH {COMPOSITE} SELECT source, CAST((score < 0.74)::INT + (facts < 0.55)::INT + (pedagogy < 0.45)::INT AS INTEGER) AS issues, CASE WHEN score < 0.74 OR facts < 0.55 OR pedagogy < 0.45 THEN 'investigate' ELSE 'healthy' END AS verdict FROM r")
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    issues = (c("score") < 0.74).cast("int") + (c("facts") < 0.55).cast("int") + (c("pedagogy") < 0.45).cast("int")
    return composite(spark, sf_dir).select("source", issues.alias("issues"), F.when(issues > 0, "investigate").otherwise("healthy").alias("verdict"))


PART = "p AS (SELECT p_partkey, p_name, p_size FROM part)"


@query(f"WITH r AS (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS i FROM part) SELECT CAST(p_partkey AS BIGINT) AS node, CAST(i AS INTEGER) AS place FROM r WHERE i <= 12")
def frontier_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 best nodes of the frontier, ties in order of arrival: a top-k, so no global sort is kept."""
    top = load(spark, sf_dir, "part").orderBy(F.desc("p_size"), "p_partkey").limit(12)
    return top.select(F.col("p_partkey").cast("long").alias("node"), F.row_number().over(Window.orderBy(F.desc("p_size"), "p_partkey")).alias("place"))


ROOTS, TERMS = ["tin", "burnished"], ["steel", "brush", "plate", "copper"]
_any = lambda c, v: f"len(list_filter([{', '.join(repr(x) for x in v)}], lambda t: contains({c}, t))) > 0"


@query(f"SELECT CAST(p_partkey AS BIGINT) AS node, CASE WHEN trim(p_type) = '' THEN 'empty' WHEN {_any('lower(p_type)', OFF_TOPIC)} THEN 'off-topic' WHEN {_any('lower(p_type)', ROOTS)} THEN 'topic-root-match' WHEN {_any('lower(p_type)', TERMS)} THEN 'lexicon-match' ELSE 'rejected' END AS reason FROM part")
def node_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node gate's deterministic checks in order; what only a model could confirm is rejected."""
    low = F.lower("p_type")
    has = lambda v: F.exists(X.arr(v), lambda t: F.contains(low, t))
    reason = F.when(F.btrim("p_type") == "", "empty").when(has(OFF_TOPIC), "off-topic").when(has(ROOTS), "topic-root-match").when(has(TERMS), "lexicon-match").otherwise("rejected")
    return load(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("node"), reason.alias("reason"))


TIERS = ["foundational", "practical", "theoretical", "reference"]


@query(f"WITH {CONFIG}, n AS (SELECT p_partkey, [{', '.join(repr(t) for t in TIERS)}][p_size % 4 + 1] AS tier FROM part) SELECT tier, source_name, CAST(count(*) AS BIGINT) AS n FROM n JOIN config ON tiers = '' OR list_contains(string_split(tiers, ','), tier) GROUP BY ALL")
def tier_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work items of nodes and the sources that fit their tier: an equi-join on the tier, sources of no tier fit all."""
    n = load(spark, sf_dir, "part").select("p_partkey", F.element_at(X.arr(TIERS), F.col("p_size") % 4 + 1).alias("tier"))
    s = source_config(spark).select("source_name", F.explode(F.when(F.col("tiers") == "", X.arr(TIERS)).otherwise(F.split("tiers", ","))).alias("tier"))
    return n.join(F.broadcast(s), "tier").groupBy("tier", "source_name").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def unused_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("SELECT DISTINCT lang, source FROM documents EXCEPT SELECT DISTINCT lang, source FROM documents JOIN labels USING (doc_id) WHERE quality = 0")
def missing_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return d.select("lang", "source").subtract(d.join(load(spark, sf_dir, "labels").where("quality = 0"), "doc_id").select("lang", "source"))


@query("WITH t AS (SELECT source, count(*) FILTER (n_chars < 300) AS thin FROM documents GROUP BY source) SELECT source, source || k AS node FROM t, (VALUES (' basics'), (' practice')) v(k) WHERE thin >= 3")
def gap_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two new nodes for each source with thin documents."""
    t = load(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(F.col("n_chars") < 300).alias("thin")).where("thin >= 3")
    return t.select("source", F.explode(F.transform(X.arr([" basics", " practice"]), lambda k: F.concat("source", k))).alias("node"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id * 2654435761 % 1000003, doc_id) AS i FROM labels) WHERE i <= 50")
def verify_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 rows to verify by hand, in the order of a hash: reproducible."""
    return load(spark, sf_dir, "labels").orderBy(F.col("doc_id") * F.lit(2654435761) % 1000003, "doc_id").limit(50).select("doc_id")


@query("SELECT CAST(l_partkey AS BIGINT) AS part, l_returnflag AS unit, CAST(count(DISTINCT l_tax) AS BIGINT) AS n_values FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_tax) > 1 AND count(DISTINCT l_orderkey) > 1")
def spec_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects with more than one value in more than one chapter."""
    g = load(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("long").alias("part"), F.col("l_returnflag").alias("unit")).agg(F.count_distinct("l_tax").alias("n_values"), F.count_distinct("l_orderkey").alias("c"))
    return g.where("n_values > 1 AND c > 1").drop("c")


@query("SELECT role, CAST(count(DISTINCT conv_id) AS BIGINT) AS chapters FROM conversations GROUP BY role HAVING count(DISTINCT conv_id) > 1")
def dup_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "conversations").select("role", "conv_id").distinct().groupBy("role").agg(F.count("*").alias("chapters")).where("chapters > 1")


USED = f"{VAULT}, u AS (SELECT source_name, count(*) AS saved, count(*) FILTER (quality = 1) AS used, count(*) FILTER (quality = 0) AS unused FROM vault LEFT JOIN labels USING (doc_id) GROUP BY source_name)"


def used(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vault(spark, sf_dir).select("doc_id", "source_name").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return v.groupBy("source_name").agg(F.count("*").alias("saved"), F.count_if(F.col("quality") == 1).alias("used"), F.count_if(F.col("quality") == 0).alias("unused"))


@query(f"WITH {USED} SELECT source_name, CAST(saved AS BIGINT) AS saved, CAST(used AS BIGINT) AS used, CAST(unused AS BIGINT) AS unused FROM u")
def used_unused_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return used(spark, sf_dir)


@query(f"WITH {USED} SELECT source_name, round((used + 1) / (greatest(saved, 1) + 1), 6) AS priority FROM u")
def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return used(spark, sf_dir).select("source_name", F.round((F.col("used") + 1) / (F.greatest("saved", F.lit(1)) + 1), 6).alias("priority"))


_ORDER = "(VALUES " + ", ".join(f"({i}, '{s[0]}')" for i, s in enumerate(SOURCES)) + ") o(place, source_name)"


@query(f"WITH {USED}, p AS (SELECT place, o.source_name, CASE WHEN saved IS NULL THEN 1.0 ELSE round((used + 1) / (greatest(saved, 1) + 1), 6) END AS priority FROM {_ORDER} LEFT JOIN u ON u.source_name = o.source_name) SELECT CAST(row_number() OVER (ORDER BY priority DESC, place) AS INTEGER) AS turn, source_name, priority FROM p")
def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns in which configured sources are searched: by priority, unknown ones have 1, ties as configured. As many rows
    as sources, so one task orders them."""
    known = source_priority(spark, sf_dir)
    order = source_config(spark).select("source_name").withColumn("place", F.array_position(X.arr([s[0] for s in SOURCES]), F.col("source_name")))
    p = order.join(known, "source_name", "left").withColumn("priority", F.coalesce("priority", F.lit(1.0)))
    return p.select(F.row_number().over(Window.orderBy(F.desc("priority"), "place")).alias("turn"), "source_name", "priority")


@query(f"WITH {VAULT} SELECT lang, CAST(count(*) FILTER (low_trust) AS BIGINT) AS low_files, CAST(count(*) FILTER (NOT low_trust) AS BIGINT) AS high_files, CAST(floor(100 * (count(*) FILTER (low_trust)) / count(*)) AS BIGINT) AS low_percent FROM vault JOIN labels USING (doc_id) GROUP BY lang")
def reliability_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vault(spark, sf_dir).select("doc_id", "lang", "low_trust").join(load(spark, sf_dir, "labels"), "doc_id")
    return v.groupBy("lang").agg(F.count_if("low_trust").alias("low_files"), F.count_if(~F.col("low_trust")).alias("high_files"), F.floor(100 * F.count_if("low_trust") / F.count("*")).alias("low_percent"))


@query(f"WITH {VAULT}, r AS (SELECT source_name, doc_id, row_number() OVER (PARTITION BY source_name ORDER BY doc_id) AS i FROM vault WHERE low_trust AND length(text) >= 80) SELECT source_name, doc_id FROM r WHERE i <= 15")
def appendix_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("source_name").orderBy("doc_id")
    return vault(spark, sf_dir).where(F.col("low_trust") & (F.length("text") >= 80)).select("source_name", "doc_id").withColumn("i", F.row_number().over(w)).where("i <= 15").drop("i")


@query("SELECT count(*) AS files, count(*) FILTER (n_chars >= 500) AS claimable, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) < 10 THEN 'few' ELSE 'needs compile' END AS stage, lang FROM documents GROUP BY lang")
def topic_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("files"), F.count_if(F.col("n_chars") >= 500).alias("claimable"), F.when(F.count("*") == 0, "empty").when(F.count("*") < 10, "few").otherwise("needs compile").alias("stage"))


assert len(SOURCES) == 19
