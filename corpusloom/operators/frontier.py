"""The frontier loop of a harvest: nodes are taken in batches, worked on, and new ones come in by gaps and by the lexicon. The state
is a small table (a row a node) that each round writes to the shared folder; what a round does to documents is the caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import OFF_TOPIC
from ..functions.records import GENERIC, topic_roots
from ..sources.connectors import successes
from ..sources.scratch import stored

# Nodes looked at and taken in a round, lexicon terms of the gate, words of a node, cited links of a search.
LOOKED_AT, TAKEN, GATE_TERMS, NODE_WORDS, CITED = 12, 6, 30, 6, 5
NODES = "node string, status string, score int, seq long, discovery string"


def node_gate(node: Column, topic: str, lexicon: list[str]) -> Column:
    """Struct of allowed and reason, by the deterministic checks in order; what only a model could confirm is rejected."""
    low = F.lower(F.btrim(node))
    has = lambda v: F.exists(X.arr(v), lambda t: F.contains(low, t)) if v else F.lit(False)
    reason = F.when(F.coalesce(low, F.lit("")) == "", "empty").when(has(OFF_TOPIC), "off-topic").when(has(topic_roots(topic)), "topic-root-match").when(has([t.lower() for t in lexicon[:GATE_TERMS]]), "lexicon-match").otherwise("rejected")
    return F.struct(reason.isin("topic-root-match", "lexicon-match").alias("allowed"), reason.alias("reason"))


def added(nodes: DataFrame, new: DataFrame, discovery: str, score: int, again: int) -> DataFrame:
    """nodes with new ones (node, seq) as pending; a stalled one is pending again with `again` points more, others stay."""
    fresh = new.select(X.first_words(F.col("node"), NODE_WORDS).alias("node"), "seq").where("node <> ''").groupBy("node").agg(F.min("seq").alias("s"))
    j = nodes.join(fresh, "node", "full")
    back = (F.col("status") == "stalled") & F.col("s").isNotNull()
    return j.select(
        "node", F.when(F.col("status").isNull() | back, "pending").otherwise(F.col("status")).alias("status"),
        F.when(F.col("status").isNull(), score).when(back, F.col("score") + again).otherwise(F.col("score")).cast("int").alias("score"),
        F.coalesce("seq", "s").alias("seq"), F.coalesce("discovery", F.lit(discovery)).alias("discovery"),
    )


def lexicon_nodes(lexicon: DataFrame) -> DataFrame:
    """Terms (term, rank) of four letters or more that aren't generic, as nodes."""
    return lexicon.where((F.length("term") >= 4) & ~F.lower("term").isin(GENERIC)).select(F.col("term").alias("node"), F.col("rank").cast("long").alias("seq"))


def batch(nodes: DataFrame, topic: str, lexicon: list[str]) -> DataFrame:
    """node and allowed of the frontier's best 12: what the gate rejects will stall, the first six of the rest are taken."""
    top = nodes.where("status IN ('pending', 'stalled') AND NOT coalesce(tried, false)").orderBy(F.desc("score"), "seq", "node").limit(LOOKED_AT)
    g = top.select("node", "score", "seq", node_gate(F.col("node"), topic, lexicon)["allowed"].alias("allowed"))
    place = F.row_number().over(Window.partitionBy("allowed").orderBy(F.desc("score"), "seq", "node"))
    return g.withColumn("place", place).where(~F.col("allowed") | (F.col("place") <= TAKEN)).select("node", "allowed")


def harvest(nodes: DataFrame, topic: str, lexicon: list[str], work: Callable[[DataFrame], DataFrame], gaps: Callable[[DataFrame], DataFrame], least_files: int, rounds: int) -> tuple[DataFrame, int, str]:
    """Rounds until there are enough files, no nodes, or `rounds` are over; returns nodes, rounds done and why it ended.
    work(batch) gives node and files (how many it saved); gaps(nodes) gives new nodes (node, seq). An empty frontier asks for
    gaps first, then for the lexicon's terms; known nodes don't come in again. A node that saved files is grounded and stays so; others stall."""
    spark = nodes.sparkSession
    terms = spark.createDataFrame([(t, i) for i, t in enumerate(lexicon)], "term string, rank int")
    state = stored(nodes.withColumns({"tried": F.lit(False), "files": F.lit(0).cast("bigint")}), "frontier")
    plain = ["node", "status", "score", "seq", "discovery"]

    def grown(now: DataFrame, new: DataFrame, discovery: str, score: int) -> DataFrame:
        fresh = new.select(X.first_words(F.col("node"), NODE_WORDS).alias("node"), "seq").join(now.select("node"), "node", "left_anti")
        out = added(now.select(*plain), fresh, discovery, score, 0).join(now.select("node", "tried", "files"), "node", "left")
        return stored(out.select(*plain, F.coalesce("tried", F.lit(False)).alias("tried"), F.coalesce("files", F.lit(0)).alias("files")), "frontier")

    for n in range(rounds):
        if (state.agg(F.sum("files")).first()[0] or 0) >= least_files:
            return state, n, "enough files"
        taken = stored(batch(state, topic, lexicon), "batch")
        for new, discovery, score in ((gaps, "gap_analysis", 2), (lambda _: lexicon_nodes(terms), "lexicon_sweep", 1)):
            if taken.where("allowed").isEmpty():
                marked = state.join(taken.withColumnRenamed("allowed", "_ok"), "node", "left")
                state = stored(marked.select("node", F.when(F.col("_ok") == F.lit(False), "stalled").otherwise(F.col("status")).alias("status"), "score", "seq", "discovery", (F.col("tried") | F.col("_ok").isNotNull()).alias("tried"), "files"), "frontier")
                state = grown(state, new(state), discovery, score)
                taken = stored(batch(state, topic, lexicon), "batch")
        if taken.where("allowed").isEmpty():
            return state, n, "no nodes"
        done = work(taken.where("allowed").select("node")).groupBy("node").agg(F.sum("files").alias("_got"))
        j = state.join(taken.withColumnRenamed("allowed", "_ok"), "node", "left").join(done, "node", "left")
        got = F.coalesce("_got", F.lit(0))
        status = F.when((F.col("status") == "grounded") | (got > 0), "grounded").when(F.col("_ok").isNotNull(), "stalled").otherwise(F.col("status"))
        state = stored(j.select("node", status.alias("status"), "score", "seq", "discovery", (F.col("tried") | F.col("_ok").isNotNull()).alias("tried"), (F.col("files") + got).alias("files")), "frontier")
        state = grown(state, gaps(state), "gap_analysis", 2)
    return state, rounds, "rounds over"


def take_cited(queue: DataFrame, most: int = CITED) -> tuple[DataFrame, DataFrame]:
    """The first links of a queue (url, seq, consumed) that aren't used up, and the queue with these marked."""
    taken = stored(queue.where("NOT consumed").orderBy("seq", "url").limit(most), "cited")
    mark = taken.select("url").distinct().withColumn("_t", F.lit(True))
    return taken, queue.join(mark, "url", "left").withColumn("consumed", F.col("consumed") | F.coalesce("_t", F.lit(False))).drop("_t")


def known_sources(attempts: DataFrame) -> DataFrame:
    """identifier, seen, saved and high_value of all attempts so far (identifier, saved): seen twice and saved once make a
    source one of high value."""
    g = attempts.groupBy("identifier").agg(F.count("*").alias("seen"), F.count_if("saved").alias("saved"))
    return g.withColumn("high_value", (F.col("seen") >= 2) & (F.col("saved") >= 1))


def cycle(found: DataFrame, known: DataFrame, skipped: DataFrame) -> DataFrame:
    """The candidates (source, node, rank, identifier, saved) that a cycle gets to: searches that show a source of high value
    among their first go deeper, and what is on the skip list is passed over. saved: what comes of a candidate if it is fetched."""
    flags = known.where("high_value").select("identifier").distinct().withColumn("high_value", F.lit(True))
    skip = skipped.select("identifier").distinct().withColumn("skip", F.lit(True))
    none = lambda c: F.coalesce(F.col(c), F.lit(False))
    marked = found.join(flags, "identifier", "left").join(skip, "identifier", "left")
    marked = marked.withColumns({"high_value": none("high_value"), "skip": none("skip")}).withColumn("saved", F.col("saved") & ~F.col("skip"))
    return successes(marked).where("NOT skip").drop("skip")
