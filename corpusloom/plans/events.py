"""Event metrics and rules: counters, windows of rows, cycle-over-cycle ratios and alerts. A cycle is a day, the event
type stands for the phase's type, the user for the source, and props' k for a filter's statistic."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions.lists import DRIFT_WINDOW
from ..operators import health
from ..registry import query
from ..sources.scratch import base_folder
from ..sources.tables import load
from ..streaming import watch


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.withColumn("cycle", F.date_format("ts", "yyyy-MM-dd")).withColumn("k", F.get_json_object("props", "$.k").cast("long"))


EV = "e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS cycle, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


@query(f"WITH {EV} SELECT cycle, event_type, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY GROUPING SETS ((event_type), (cycle, event_type))")
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupingSets([["event_type"], ["cycle", "event_type"]], "cycle", "event_type").agg(F.count("*").alias("n")).select("cycle", "event_type", "n")


@query(f"WITH {EV} SELECT cycle, CAST(count(*) AS BIGINT) AS n, CAST(sum(k) AS BIGINT) AS total FROM e GROUP BY cycle")
def events_by_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("cycle").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query(f"WITH {EV}, p AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS saves, count(*) FILTER (event_type = 'error') AS rejects FROM e GROUP BY user_id) SELECT user_id, CAST(saves AS BIGINT) AS saves, CAST(rejects AS BIGINT) AS rejects, round(saves / (saves + rejects), 6) AS save_rate FROM p WHERE saves + rejects > 0")
def agent_productivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = events(spark, sf_dir).groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("saves"), F.count_if(F.col("event_type") == "error").alias("rejects"))
    return p.where("saves + rejects > 0").withColumn("save_rate", F.round(F.col("saves") / (F.col("saves") + F.col("rejects")), 6))


@query(f"WITH {EV} SELECT cycle, event_type AS filter, CAST(sum(k) AS BIGINT) AS n FROM e GROUP BY cycle, event_type")
def filter_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("cycle", F.col("event_type").alias("filter")).agg(F.sum("k").alias("n"))


@query(f"""WITH {EV}, s AS (SELECT cycle, event_type AS filter, sum(k) AS n FROM e GROUP BY ALL), q AS (SELECT cycle, avg(value) AS score FROM e GROUP BY cycle), c AS (SELECT cycle, lag(cycle) OVER (ORDER BY cycle) AS before, score, lag(score) OVER (ORDER BY cycle) AS was FROM q),
    g AS (SELECT c.*, f.filter FROM c, (SELECT DISTINCT filter FROM s) f WHERE before IS NOT NULL)
    SELECT g.cycle, g.filter, CAST(coalesce(p.n, 0) AS BIGINT) AS prev, CAST(coalesce(n.n, 0) AS BIGINT) AS curr, CASE WHEN coalesce(p.n, 0) = 0 THEN NULL ELSE round(coalesce(n.n, 0) / p.n, 6) END AS ratio, score < was AS quality_dropped
    FROM g LEFT JOIN s p ON p.cycle = before AND p.filter = g.filter LEFT JOIN s n ON n.cycle = g.cycle AND n.filter = g.filter WHERE coalesce(p.n, 0) <> 0 OR coalesce(n.n, 0) <> 0""")
def filter_ratio_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each filter's statistic against the cycle before; a missing one is 0, a ratio to 0 is null (infinite)."""
    e = events(spark, sf_dir)
    w = Window.orderBy("cycle")  # cycles are few: one row for each day
    c = e.groupBy("cycle").agg(F.avg("value").alias("score")).select("cycle", F.lag("cycle").over(w).alias("before"), (F.col("score") < F.lag("score").over(w)).alias("quality_dropped"))
    s = e.groupBy("cycle", F.col("event_type").alias("filter")).agg(F.sum("k").alias("n"))
    now = s.join(c, "cycle").where("before IS NOT NULL").select("cycle", "before", "quality_dropped", "filter", F.col("n").alias("curr"))
    old = c.where("before IS NOT NULL").join(s.select(F.col("cycle").alias("before"), "filter", F.col("n").alias("prev")), "before")
    both = now.join(old.select("cycle", "filter", "prev", F.col("quality_dropped").alias("q2")), ["cycle", "filter"], "full")
    prev, curr = F.coalesce("prev", F.lit(0)), F.coalesce("curr", F.lit(0))
    return both.where((prev != 0) | (curr != 0)).select("cycle", "filter", prev.alias("prev"), curr.alias("curr"), F.when(prev != 0, F.round(curr / prev, 6)).alias("ratio"), F.coalesce("quality_dropped", "q2").alias("quality_dropped"))


@query(f"""WITH {EV}, r AS (SELECT user_id, event_id, event_type, count(*) OVER w AS n, count(*) FILTER (event_type = 'error') OVER w AS bad FROM e WHERE event_type IN ('error', 'view') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS {DRIFT_WINDOW - 1} PRECEDING))
    SELECT user_id, event_id, CAST(bad AS BIGINT) AS bad FROM r WHERE n >= 10 AND bad >= 7""")
def pollution_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert rows: of the last 20 rejections, ten at least, seven or more are drift."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-(DRIFT_WINDOW - 1), 0)
    r = events(spark, sf_dir).where(F.col("event_type").isin("error", "view"))
    return r.select("user_id", "event_id", F.count("*").over(w).alias("n"), F.count_if(F.col("event_type") == "error").over(w).alias("bad")).where("n >= 10 AND bad >= 7").select("user_id", "event_id", "bad")


SCORES = f"{EV}, q AS (SELECT user_id, cycle, avg(value) AS score FROM e GROUP BY ALL), d AS (SELECT user_id, cycle, score - lag(score) OVER (PARTITION BY user_id ORDER BY cycle) AS delta FROM q)"


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of scores from cycle to cycle; thresholds are met to the last bit, so values are added in order of time."""
    e = load(spark, sf_dir, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("cycle"), "ts", "event_id", "value")
    q = N.running(e, "value", ["user_id", "cycle"], ["ts", "event_id"]).groupBy("user_id", "cycle").agg(N.last_mean("value").alias("score"))
    return q.withColumn("delta", F.col("score") - F.lag("score").over(Window.partitionBy("user_id").orderBy("cycle")))


@query(f"WITH {SCORES} SELECT user_id, round(min(delta), 6) AS worst FROM d GROUP BY user_id")
def cycle_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas(spark, sf_dir).groupBy("user_id").agg(F.round(F.min("delta"), 6).alias("worst"))


@query(f"WITH {SCORES} SELECT user_id, cycle, CASE WHEN abs(delta) < 0.02 THEN 'plateau' ELSE 'regression' END AS kind FROM d WHERE abs(delta) < 0.02 OR delta < -0.05")
def plateau_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas(spark, sf_dir).where("abs(delta) < 0.02 OR delta < -0.05").select("user_id", "cycle", F.when(F.abs("delta") < 0.02, "plateau").otherwise("regression").alias("kind"))


@query(f"WITH {EV} SELECT cycle, event_type AS kind, CAST(arg_min(event_id, event_id) AS BIGINT) AS first FROM e WHERE event_type IN ('error', 'signup') GROUP BY cycle, event_type")
def alert_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first alert of a kind in a cycle."""
    return events(spark, sf_dir).where(F.col("event_type").isin("error", "signup")).groupBy("cycle", F.col("event_type").alias("kind")).agg(F.min("event_id").alias("first"))


@query(f"WITH {EV}, r AS (SELECT user_id AS run, cycle, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM e WHERE event_type = 'error') SELECT run, cycle, CAST(min(i) AS BIGINT) AS errors, arg_min(event_id, i) AS event FROM r WHERE i >= 5 GROUP BY run, cycle")
def model_unstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts about runs (users) whose model has failed five times, once a cycle."""
    e = events(spark, sf_dir).where("event_type = 'error'")
    return health.unstable(e.select(F.col("user_id").alias("run"), "cycle", "ts", F.col("event_id").alias("event")))


@query(f"WITH {EV}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM e) SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END), 6) AS reference_ratio, round(avg(coalesce(value, 0)), 6) AS density FROM n WHERE i <= 20 GROUP BY user_id")
def drift_last20(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = events(spark, sf_dir).withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))).where(f"i <= {DRIFT_WINDOW}")
    return n.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg((F.col("event_type") == "view").cast("double")), 6).alias("reference_ratio"), F.round(F.avg(F.coalesce("value", F.lit(0.0))), 6).alias("density"))


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS posts, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS digest FROM conversations WHERE length(text) >= 40 GROUP BY conv_id")
def thread_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of posts that are long enough, in order."""
    posts = load(spark, sf_dir, "conversations").where(F.length("text") >= 40)
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))))
    return posts.groupBy("conv_id").agg(F.count("*").alias("posts"), lines.alias("l")).select("conv_id", "posts", F.md5(F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("digest"))


def _stream(spark: SparkSession, sf_dir: str, fn, mode: str) -> DataFrame:
    from ..streaming import rules

    return rules.drain(spark, f"{sf_dir}/events.parquet", fn, mode)


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters as a stream that has read all that is there."""
    return _stream(spark, sf_dir, lambda e: e.groupBy("event_type").agg(F.count("*").alias("n")), "complete")


@query("SELECT strftime(ts, '%Y-%m-%d') AS cycle, event_type AS kind FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream, each kind once in a cycle."""
    return _stream(spark, sf_dir, lambda e: e.where(F.col("event_type").isin("error", "signup")).select(F.date_format("ts", "yyyy-MM-dd").alias("cycle"), F.col("event_type").alias("kind")).dropDuplicates(["cycle", "kind"]), "append")


_RUNS = f"""{EV}, cl AS (SELECT user_id AS run, event_type AS source FROM e),
    cy AS (SELECT user_id AS run, cycle, round(avg(coalesce(value, 0)) / 100, 6) AS score, round(count(*) FILTER (event_type = 'purchase') / count(*), 6) AS facts, round(count(*) FILTER (event_type = 'view') / count(*), 6) AS pedagogy FROM e GROUP BY ALL),
    ef AS (SELECT user_id AS run, cycle, event_type AS filter, CAST(coalesce(sum(k), 0) AS BIGINT) AS n FROM e GROUP BY ALL),
    st AS (SELECT run, cycle, lag(cycle) OVER (PARTITION BY run ORDER BY cycle) AS before FROM (SELECT DISTINCT run, cycle FROM ef)),
    dr AS (SELECT st.run, st.cycle, st.before, coalesce(a.score, 0) < coalesce(b.score, 0) - 0.03 AS dropped FROM st LEFT JOIN cy a ON a.run = st.run AND a.cycle = st.cycle LEFT JOIN cy b ON b.run = st.run AND b.cycle = st.before WHERE before IS NOT NULL),
    al AS (SELECT run, cycle, filter, sum(prev) AS prev, sum(curr) AS curr FROM (SELECT run, cycle, filter, 0 AS prev, n AS curr FROM ef UNION ALL SELECT dr.run, dr.cycle, filter, n, 0 FROM dr JOIN ef ON ef.run = dr.run AND ef.cycle = dr.before) GROUP BY ALL),
    bad AS (SELECT run, cycle, filter, prev, curr FROM al JOIN dr USING (run, cycle) WHERE dropped AND (prev <> 0 OR curr <> 0) AND (prev = 0 OR curr / prev >= 2))"""


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stand-ins: a user is a run, an event type the source of a claim and a filter, a day a cycle."""
    e = events(spark, sf_dir)
    share = lambda t: F.round(F.count_if(F.col("event_type") == t) / F.count("*"), 6)
    cycles = e.groupBy(F.col("user_id").alias("run"), "cycle").agg(F.round(F.avg(F.coalesce("value", F.lit(0.0))) / 100, 6).alias("score"), share("purchase").alias("facts"), share("view").alias("pedagogy"))
    effects = e.groupBy(F.col("user_id").alias("run"), "cycle", F.col("event_type").alias("filter")).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n")).withColumn("stat", F.lit("k"))
    return e.select(F.col("user_id").alias("run"), F.col("event_type").alias("source_name")), cycles, effects


@query(f"""WITH {_RUNS}, sh AS (SELECT run, avg(CASE WHEN source IN ('view', 'signup') THEN 1.0 ELSE 0.0 END) AS share FROM cl GROUP BY run), de AS (SELECT run, cycle, score, facts, pedagogy, score - lag(score) OVER (PARTITION BY run ORDER BY cycle) AS delta FROM cy),
    me AS (SELECT run, min(delta) AS delta, arg_max(score, cycle) AS score, arg_max(facts, cycle) AS facts, arg_max(pedagogy, cycle) AS pedagogy FROM de GROUP BY run),
    nm AS (SELECT run, list(filter || '.k' ORDER BY i) AS named FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY CASE WHEN prev = 0 THEN 1e300 ELSE curr / prev END DESC, cycle, filter) AS i FROM bad) WHERE i <= 3 GROUP BY run),
    x AS (SELECT run, share, delta, list_concat(list_concat(list_filter([CASE WHEN share < 0.20 THEN 'reference share' END, CASE WHEN delta < -0.05 THEN 'score drop' END], lambda v: v IS NOT NULL), coalesce(named, [])),
        list_filter([CASE WHEN score < 0.74 THEN 'score floor' END, CASE WHEN facts < 0.55 THEN 'facts floor' END, CASE WHEN pedagogy < 0.45 THEN 'pedagogy floor' END], lambda v: v IS NOT NULL)) AS issues FROM sh JOIN me USING (run) LEFT JOIN nm USING (run))
    SELECT run, round(share, 6) AS reference_share, round(delta, 6) AS worst_delta, array_to_string(issues, ', ') AS issues, CASE WHEN len(issues) = 0 THEN 'healthy' ELSE 'investigate' END AS verdict FROM x""")
def run_health_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues of each run, and the verdict."""
    h = health.health(*runs(spark, sf_dir), ["view", "signup"])
    return h.select("run", F.round("reference_share", 6).alias("reference_share"), F.round("worst_delta", 6).alias("worst_delta"), F.array_join("issues", ", ").alias("issues"), "verdict")


@query(f"""WITH {_RUNS} SELECT run, cycle, filter, CAST(prev AS BIGINT) AS prev, CAST(curr AS BIGINT) AS curr FROM bad WHERE curr >= 5 AND prev > 0""")
def filter_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters that strip twice as much as in the cycle before while the run's score fell."""
    _, cycles, effects = runs(spark, sf_dir)
    return health.over_stripping(effects, cycles).select("run", "cycle", "filter", "prev", "curr")


SILENCE_DAYS = 3
_CARDS = f"""e AS (SELECT user_id AS run, event_id AS seq, ts, CASE WHEN event_type = 'signup' AND value < 20 THEN 'start' WHEN event_type = 'purchase' AND value < 20 THEN 'end'
        WHEN event_type = 'error' THEN 'drift' WHEN event_type = 'signup' THEN 'reject' WHEN event_type = 'click' THEN 'error' ELSE 'save' END AS kind FROM events),
    o AS (SELECT *, lag(ts) OVER w AS was, lag(kind) OVER w AS before FROM e WINDOW w AS (PARTITION BY run ORDER BY ts, seq)),
    b AS (SELECT *, sum(CASE WHEN kind = 'start' OR before IS NULL OR before = 'end' OR ts - was > INTERVAL {SILENCE_DAYS} DAY THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY ts, seq) AS part FROM o),
    n AS (SELECT *, row_number() OVER (PARTITION BY run, part ORDER BY ts, seq) AS i, row_number() OVER (PARTITION BY run, part ORDER BY ts DESC, seq DESC) AS back, count(*) FILTER (kind IN ('drift', 'reject')) OVER (PARTITION BY run, part ORDER BY ts, seq) AS r FROM b),
    w AS (SELECT run, part, count(*) OVER x AS n, count(*) FILTER (kind = 'drift') OVER x AS bad FROM n WHERE kind IN ('drift', 'reject') WINDOW x AS (PARTITION BY run, part ORDER BY r ROWS 19 PRECEDING)),
    polluted AS (SELECT DISTINCT run, part FROM w WHERE n >= 10 AND bad >= 7),
    s AS (SELECT run, part, min(seq) FILTER (i = 1) AS started, min(kind) FILTER (i = 1) AS first, min(seq) FILTER (back = 1) AS last, min(kind) FILTER (back = 1) AS how, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS events,
        count(*) FILTER (kind = 'save') AS saves, count(*) FILTER (kind IN ('drift', 'reject')) AS rejects, count(*) FILTER (kind = 'error') AS errors FROM n GROUP BY run, part),
    t AS (SELECT *, coalesce(lead(first_ts) OVER (PARTITION BY run ORDER BY part), (SELECT max(ts) FROM events)) - last_ts > INTERVAL {SILENCE_DAYS} DAY AS silent FROM s)"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-ins: a user's events are those of runs, one after another; some signups start a run, some purchases end it."""
    low, kind = F.col("value") < 20, F.col("event_type")
    name = F.when((kind == "signup") & low, "start").when((kind == "purchase") & low, "end").when(kind == "error", "drift").when(kind == "signup", "reject").when(kind == "click", "error").otherwise("save")
    return load(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), name.alias("kind"))


@query(f"""WITH {_CARDS} SELECT t.run, started, CASE WHEN how = 'end' THEN last END AS ended, CAST(events AS BIGINT) AS events, CAST(saves AS BIGINT) AS saves, CAST(rejects AS BIGINT) AS rejects,
    array_to_string(list_filter([CASE WHEN errors >= 5 THEN 'model unstable' END, CASE WHEN p.run IS NOT NULL THEN 'pollution' END], lambda x: x IS NOT NULL), ', ') AS alerts
    FROM t LEFT JOIN polluted p ON p.run = t.run AND p.part = t.part WHERE first = 'start' AND (how = 'end' OR silent)""")
def stream_run_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of runs that ended, or fell silent for three days, from a stream over all events."""
    path = f"{base_folder(spark)}/cards-{uuid.uuid4().hex}"
    rows = run_events(spark, sf_dir)
    rows.write.parquet(f"{path}/events")
    watch.collected(watch.cards(spark.readStream.schema(rows.schema).parquet(f"{path}/events"), SILENCE_DAYS * 86400.0), path, "append")
    return spark.read.parquet(f"{path}/rows").select("run", "started", "ended", "events", "saves", "rejects", "alerts")


@query(f"WITH {_RUNS} SELECT run, cycle, filter, CAST(prev AS BIGINT) AS prev, CAST(curr AS BIGINT) AS curr FROM bad WHERE curr >= 5 AND prev > 0")
def stream_filter_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters' verdicts from a stream in which the cycles' quality arrives after all counts: late rows re-open them. Runs
    are those of filter_regressions."""
    path = f"{base_folder(spark)}/recheck-{uuid.uuid4().hex}"
    _, cycles, effects = runs(spark, sf_dir)
    counts = effects.select("run", F.lit("count").alias("kind"), "cycle", "filter", "n", F.lit(None).cast("double").alias("score"))
    quality = cycles.select("run", F.lit("quality").alias("kind"), "cycle", F.lit(None).cast("string").alias("filter"), F.lit(None).cast("long").alias("n"), "score")
    for part in (counts, quality):
        part.write.mode("append").parquet(f"{path}/in")
        watch.collected(watch.verdicts(spark.readStream.schema(counts.schema).parquet(f"{path}/in")), path, "update")
    last = F.max_by(F.struct("prev", "curr", "over"), "version").alias("v")
    return spark.read.parquet(f"{path}/rows").groupBy("run", "cycle", "filter").agg(last).where("v.over").select("run", "cycle", "filter", "v.prev", "v.curr")
