"""Probes: checks of a writer or of a gate, each a DataFrame of one row (probe, verdict, metrics as columns)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import text as X

PROBES: dict[str, tuple[Callable[..., DataFrame], str]] = {}
# Shares and seconds that decide a verdict.
PASS_RATE, FAIR_RATE, FAST, SLOW, LEAST_MARKERS = 0.70, 0.40, 5.0, 15.0, 3
SPECIFIC = f"(?i:{M.NUMBER_UNIT})|(?i:{M.YEAR})|(?i:{M.STANDARD})"


def probe(name: str, about: str) -> Callable:
    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        PROBES[name] = (fn, about)
        return fn

    return add


def _three(bad: Column, good: Column, fair: Column) -> Column:
    return F.when(bad, "FAIL").when(good, "PASS").when(fair, "INCONCLUSIVE").otherwise("FAIL")


@probe("claim-attribution", "Whether a writer marks sentences with specific values by the claims it was given.")
def claim_attribution(outputs: DataFrame, claims_given: int) -> DataFrame:
    """outputs: text of one or more runs. A marker beyond the claims given fails; no specific sentence is inconclusive."""
    s = F.filter(X.sentences(F.col("text")), lambda x: F.length(F.btrim(x)) >= 20)
    own = F.filter(s, lambda x: x.rlike(SPECIFIC))
    cited = F.transform(F.regexp_extract_all("text", F.lit(r"\[C(\d+)\]"), 1), lambda x: x.cast("int"))
    rows = outputs.select(
        F.size(s).alias("s"), F.size(own).alias("o"), F.size(F.filter(own, lambda x: x.rlike(r"\[C\d+\]"))).alias("a"), F.size(cited).alias("c"),
        F.size(F.filter(cited, lambda i: (i < 1) | (i > claims_given))).alias("h"),
    )
    total = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("s", "sentences"), ("o", "specific"), ("a", "attributed"), ("c", "markers"), ("h", "hallucinated"))])
    rate = F.coalesce(F.try_divide(F.col("attributed"), F.col("specific")), F.lit(0.0))
    v = F.when(F.col("specific") == 0, "INCONCLUSIVE").otherwise(_three(F.col("hallucinated") > 0, rate >= PASS_RATE, rate >= FAIR_RATE))
    return total.select(F.lit("claim-attribution").alias("probe"), v.alias("verdict"), "sentences", "specific", "attributed", F.round(rate, 3).alias("rate"), "markers", "hallucinated")


@probe("call-latency", "Whether a model answers small calls in time.")
def call_latency(calls: DataFrame) -> DataFrame:
    """calls: seconds, failed."""
    t = calls.agg(F.count("*").alias("calls"), F.avg("seconds").alias("m"), F.max("seconds").alias("x"), F.min("seconds").alias("n"), F.count_if("failed").alias("failures"))
    v = _three((F.col("failures") > 0) | (F.col("calls") == 0), F.col("m") < FAST, F.col("m") < SLOW)
    return t.select(F.lit("call-latency").alias("probe"), v.alias("verdict"), "calls", F.round("m", 2).alias("avg_sec"), F.round("x", 2).alias("max_sec"), F.round("n", 2).alias("min_sec"), "failures")


@probe("marker-verification", "Markers of a writer's output, checked and taken out.")
def marker_verification(checked: DataFrame) -> DataFrame:
    """checked: content, verified, tentative, flagged and hallucinated of each chapter, as the marker check counts them."""
    r = checked.select(
        F.size(X.marker_ids(F.col("content"))).alias("k"), X.strip_markers(F.col("content")).rlike(r"\[C\d").cast("int").alias("left"), "verified", "tentative", "flagged", "hallucinated",
    )
    t = r.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("k", "markers"), ("left", "residual"), ("verified", "verified"), ("tentative", "tentative"), ("flagged", "flagged"), ("hallucinated", "hallucinated"))])
    n = F.col("verified") + F.col("tentative") + F.col("flagged")
    score = F.coalesce(F.try_divide(F.col("verified") + 0.5 * F.col("tentative"), n), F.lit(1.0))
    v = F.when((F.col("markers") == 0) | (F.col("residual") > 0) | (F.col("hallucinated") > 0), "FAIL").when(F.col("markers") < LEAST_MARKERS, "INCONCLUSIVE").when(score >= PASS_RATE, "PASS").otherwise("INCONCLUSIVE")
    return t.select(F.lit("marker-verification").alias("probe"), v.alias("verdict"), "markers", "verified", "tentative", "flagged", "hallucinated", F.round(score, 3).alias("score"))


@probe("drift-gate-precision", "Whether the node gate keeps nodes on the topic and rejects others.")
def drift_gate_precision(nodes: DataFrame) -> DataFrame:
    """nodes: allowed (the gate's decision) and on_topic (the truth). A node off the topic that passes fails the gate, as do
    two on it that don't; one such is inconclusive."""
    ok, on = F.col("allowed"), F.col("on_topic")
    t = nodes.agg(F.count_if(ok & on).alias("on_accepted"), F.count_if(~ok & on).alias("on_rejected"), F.count_if(~ok & ~on).alias("off_rejected"), F.count_if(ok & ~on).alias("off_accepted"))
    v = _three((F.col("off_accepted") > 0) | (F.col("on_rejected") > 1), F.col("on_rejected") == 0, F.lit(True))
    return t.select(F.lit("drift-gate-precision").alias("probe"), v.alias("verdict"), "on_accepted", "on_rejected", "off_rejected", "off_accepted")


def specifics_first(claims: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """A sample of claims (claim_id, specific): of those with specific values first, then of all, so a specific claim can
    come twice where there are fewer than `most`. The order is that of a hash of id and seed: a task keeps `most` rows, and
    the sample is the same however claims are spread."""
    key = F.md5(F.concat(F.col("claim_id").cast("string"), F.lit(f":{seed}")))
    rows = claims.select("claim_id", "specific", key.alias("key"))
    twice = F.explode(F.when(F.col("specific"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("turn")
    return rows.select("claim_id", "specific", "key", twice).orderBy("turn", "key", "claim_id").limit(most).select("claim_id", "specific", "turn")
