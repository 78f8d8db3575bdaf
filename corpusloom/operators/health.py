"""Health of runs: share of reference sources, score changes between cycles, filters that strip more while quality falls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Least share of reference sources, largest drop of a score, a filter's jump and the drop that goes with it, floors.
LEAST_SHARE, SCORE_DROP = 0.20, -0.05
JUMP, DROP, LEAST_COUNT = 2.0, 0.03, 5
FLOORS = {"score": 0.74, "facts": 0.55, "pedagogy": 0.45}
#: Filters that a run's issues name at most, those with the largest jump.
NAMED = 3


def filter_ratios(effects: DataFrame, cycles: DataFrame) -> DataFrame:
    """run, cycle, filter, stat, prev, curr, ratio and quality_dropped: each statistic (run, cycle, filter, stat, n) against
    the run's cycle before that has any. A missing statistic or score (run, cycle, score) is 0; a ratio to 0 is null."""
    order = Window.partitionBy("run").orderBy("cycle")
    step = effects.select("run", "cycle").distinct().withColumn("before", F.lag("cycle").over(order)).where("before IS NOT NULL")
    score = cycles.select("run", "cycle", "score")
    step = step.join(score, ["run", "cycle"], "left").withColumnRenamed("score", "now").join(score.select("run", F.col("cycle").alias("before"), F.col("score").alias("was")), ["run", "before"], "left")
    step = step.select("run", "cycle", "before", (F.coalesce("now", F.lit(0.0)) < F.coalesce("was", F.lit(0.0)) - DROP).alias("quality_dropped"))
    curr = effects.select("run", "cycle", "filter", "stat", F.col("n").alias("curr"), F.lit(0).cast("long").alias("prev"))
    prev = step.select("run", "cycle", "before").join(effects.select("run", F.col("cycle").alias("before"), "filter", "stat", F.col("n").alias("prev")), ["run", "before"])
    both = curr.unionByName(prev.select("run", "cycle", "filter", "stat", F.lit(0).cast("long").alias("curr"), "prev")).groupBy("run", "cycle", "filter", "stat").agg(F.sum("prev").alias("prev"), F.sum("curr").alias("curr"))
    out = both.where("prev <> 0 OR curr <> 0").join(step.drop("before"), ["run", "cycle"])
    return out.select("run", "cycle", "filter", "stat", "prev", "curr", F.when(F.col("prev") > 0, F.col("curr") / F.col("prev")).alias("ratio"), "quality_dropped")


def health(claims: DataFrame, cycles: DataFrame, effects: DataFrame, reference: list[str]) -> DataFrame:
    """run, reference_share, worst_delta, issues and verdict of each run in claims (run, source_name), cycles (run, cycle,
    score, facts, pedagogy) or effects (run, cycle, filter, stat, n). Null measures break no floor; a run without claims
    has a share of 0. Issues, in this order: few reference sources, a score's drop, filters (largest jump first), floors."""
    share = claims.groupBy("run").agg(F.avg(F.coalesce(F.col("source_name").isin(reference), F.lit(False)).cast("double")).alias("share"))
    moved = cycles.withColumn("delta", F.col("score") - F.lag("score").over(Window.partitionBy("run").orderBy("cycle")))
    latest = F.max_by(F.struct("score", "facts", "pedagogy"), "cycle").alias("latest")
    measures = moved.groupBy("run").agg(F.min("delta").alias("delta"), latest)
    jump = F.when(F.col("ratio").isNull(), F.lit(float("inf"))).otherwise(F.col("ratio"))
    bad = filter_ratios(effects, cycles).where("quality_dropped").withColumn("jump", jump).where(F.col("jump") >= JUMP)
    rank = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("jump"), "cycle", "filter", "stat"))
    named = bad.withColumn("i", rank).where(F.col("i") <= NAMED).groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.concat("filter", F.lit("."), "stat").alias("x")))), lambda r: r["x"]).alias("named"))
    runs = claims.select("run").unionByName(cycles.select("run")).unionByName(effects.select("run")).distinct()
    r = runs.join(share, "run", "left").join(measures, "run", "left").join(named, "run", "left")
    part = F.coalesce("share", F.lit(0.0))
    floors = [F.when(F.col(f"latest.{name}") < floor, f"{name} floor") for name, floor in FLOORS.items()]
    first = F.array_compact(F.array(F.when(part < LEAST_SHARE, "reference share"), F.when(F.col("delta") < SCORE_DROP, "score drop")))
    issues = F.concat(first, F.coalesce("named", F.array().cast("array<string>")), F.array_compact(F.array(*floors)))
    return r.select("run", part.alias("reference_share"), F.col("delta").alias("worst_delta"), issues.alias("issues"), F.when(F.size(issues) == 0, "healthy").otherwise("investigate").alias("verdict"))


def over_stripping(effects: DataFrame, cycles: DataFrame) -> DataFrame:
    """run, cycle, filter, stat, prev and curr where a filter's largest statistic of a cycle, five or more, has at least
    doubled on the cycle before, while the run's score fell."""
    top = Window.partitionBy("run", "cycle", "filter").orderBy(F.desc("curr"), "stat")
    r = filter_ratios(effects, cycles).withColumn("i", F.row_number().over(top)).where("i = 1")
    return r.where((F.col("curr") >= LEAST_COUNT) & (F.col("ratio") >= JUMP) & F.col("quality_dropped")).select("run", "cycle", "filter", "stat", "prev", "curr")


def unstable(errors: DataFrame, least: int = 5) -> DataFrame:
    """run, cycle, errors and event of the alerts about a model: in each cycle the first of errors (run, cycle, ts, event) at which
    the run has had `least` of them, earlier cycles counted. Cycles are counted first, and of a cycle only its first few errors
    are ranked, so a run with most of the errors is no large group."""
    n = errors.groupBy("run", "cycle").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("run").orderBy("cycle").rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    n = n.withColumn("i", F.greatest(F.lit(1), least - F.col("before")).cast("int")).where("n >= i")
    first = errors.withColumn("i", F.row_number().over(Window.partitionBy("run", "cycle").orderBy("ts", "event"))).where(F.col("i") <= least)
    return n.join(first, ["run", "cycle", "i"]).select("run", "cycle", (F.col("before") + F.col("i")).alias("errors"), "event")
