"""Reports as sinks. What is counted stays a DataFrame; a report renders small aggregates (a row a cycle, source, phase, chapter)
as one markdown text, built by Spark from ordered lines, and written as a file in a folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import stored

# Ratios that show a trend, phases of a summary, nodes of a gap report by kind.
TWICE, HALF, PHASES, TOPICS_A_CHAPTER, UNUSED_FILES, HITS_A_FILE = 2.0, 0.5, 10, 4, 10, 3


def percent(c: Column) -> Column:
    return F.format_string("%.0f%%", 100 * c.cast("double"))


def row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), F.lit(" |"))


def table(df: DataFrame, cells: dict[str, Column], order: list) -> DataFrame:
    """One row, md: a markdown table of a bounded DataFrame, its rows in order; null where there are no rows."""
    keys = [F.expr(o) if isinstance(o, str) else o for o in order]
    lines = df.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], row(*cells.values()).alias("line")).alias("r"))
    body = lines.agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]).alias("lines"))
    head = f"| {' | '.join(cells)} |\n|{'---|' * len(cells)}\n"
    return body.select(F.when(F.size("lines") > 0, F.concat(F.lit(head), F.array_join("lines", "\n"))).alias("md"))


def bullets(df: DataFrame, line: Column, order: list[str]) -> DataFrame:
    """One row, md: lines as a list; null where there are none."""
    got = df.select(F.struct(*[F.col(o).alias(f"k{i}") for i, o in enumerate(order)], F.concat(F.lit("- "), line).alias("line")).alias("r"))
    return got.agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]).alias("l")).select(F.when(F.size("l") > 0, F.array_join("l", "\n")).alias("md"))


def document(title: str, sections: list[tuple[str, DataFrame, str | None]]) -> DataFrame:
    """One row, markdown: a title and sections (heading, a row with md, text for an empty one; None leaves it out)."""
    out = sections[0][1].sparkSession.createDataFrame([(f"# {title}",)], "markdown string")
    for heading, part, empty in sections:
        md = part.select(F.max("md").alias("md"))  # one row, whatever the part has
        body = F.coalesce("md", F.lit(empty))
        out = out.join(md, F.lit(True)).select(F.when(body.isNull(), F.col("markdown")).otherwise(F.concat("markdown", F.lit(f"\n\n## {heading}\n\n"), body)).alias("markdown"))
    return out


def phase_timings(events: DataFrame) -> DataFrame:
    """phase, calls, total_sec and avg_sec of events (run_id, seq, ts in seconds, phase, type start or end). A start pairs with the
    phase's next event if that is an end; an open phase counts a call only."""
    w = Window.partitionBy("run_id", "phase").orderBy("seq")
    e = events.where("type IN ('start', 'end')").withColumns({"_type": F.lead("type").over(w), "_ts": F.lead("ts").over(w)}).where("type = 'start'")
    spent = F.when(F.col("_type") == "end", F.col("_ts") - F.col("ts"))
    g = e.groupBy("run_id", "phase").agg(F.count("*").alias("calls"), F.coalesce(F.sum(spent), F.lit(0.0)).alias("t"))
    return g.select("run_id", "phase", "calls", F.round("t", 1).alias("total_sec"), F.round(F.col("t") / F.greatest("calls", F.lit(1)), 2).alias("avg_sec"))


def trend(before: Column, now: Column) -> Column:
    ratio = now / before
    return F.when(F.coalesce(before, F.lit(0)) <= 0, "—").when(ratio >= TWICE, F.format_string("+%.1fx", ratio)).when(ratio <= HALF, F.when(now == 0, "-").otherwise(F.format_string("-%.1fx", before / now))).otherwise("≈")


def run_summary(topic: str, quality: DataFrame, alerts: DataFrame, agents: DataFrame, phases: DataFrame) -> DataFrame:
    """The summary of a run. quality: cycle, score, facts, pedagogy; alerts: kind, cycle, message; agents: source, saves,
    rejects; phases: phase, calls, total_sec, avg_sec."""
    rate = F.col("saves") / (F.col("saves") + F.col("rejects"))
    two = lambda c: F.format_string("%.2f", F.col(c).cast("double"))
    best = phases.orderBy(F.desc("total_sec"), "phase").limit(PHASES)
    return document(f"Run Summary — {topic}", [
        ("Cycle Quality", table(quality, {"Cycle": F.col("cycle"), "Score": two("score"), "Facts": percent(F.col("facts")), "Pedagogy": percent(F.col("pedagogy"))}, ["cycle"]), "*No cycles.*"),
        ("Alerts", bullets(alerts, F.concat(F.lit("**"), "kind", F.lit("** (cycle "), F.col("cycle").cast("string"), F.lit("): "), "message"), ["cycle", "kind", "message"]), "*No alerts raised.*"),
        ("Agent Productivity", table(agents.where("saves + rejects > 0"), {"Agent": F.col("source"), "Saves": F.col("saves"), "Rejects": F.col("rejects"), "Save Rate": percent(rate)}, [-rate, "source"]), None),
        ("Phase Timings (top 10 by total time)", table(best, {"Phase": F.col("phase"), "Calls": F.col("calls"), "Total (s)": F.col("total_sec"), "Avg (s)": F.col("avg_sec")}, [-F.col("total_sec"), "phase"]), None),
    ])


def fact_report(topic: str, chapters: DataFrame, flagged: DataFrame) -> DataFrame:
    """The fact check of a book. chapters: no, title, verified, tentative, flagged, score; flagged: no, title, claim, keywords."""
    n = F.col("verified") + F.col("tentative") + F.col("flagged")
    t = chapters.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("verified", "tentative", "flagged")], F.coalesce(F.avg("score"), F.lit(0.0)).alias("score"))
    head = t.select(F.format_string("**%d claims checked** | **%d verified** | **%d tentative** | **%d flagged** | **Accuracy score: %.0f%%**", "n", "verified", "tentative", "flagged", 100 * F.col("score")).alias("md"))
    cells = {"Chapter": F.col("title"), "Claims": n, "Verified": F.col("verified"), "Tentative": F.col("tentative"), "Flagged": F.col("flagged"), "Score": percent(F.col("score"))}
    line = F.concat(F.lit("**"), "title", F.lit("** — "), "claim", F.when(F.size("keywords") > 0, F.concat(F.lit("\n  - Keywords searched: "), F.array_join("keywords", ", "))).otherwise(""))
    return document(f"{topic.replace('_', ' ').title()} — Book Fact-Check Report", [("Totals", head, None), ("Per-Chapter Summary", table(chapters, cells, ["no"]), "*No chapters.*"), ("All Flagged Claims", bullets(flagged, line, ["no", "claim"]), None)])


def fact_json(topic: str, chapters: DataFrame) -> DataFrame:
    """The same as one JSON text, chapters in order, shares with three digits."""
    c = F.array_sort(F.collect_list(F.struct("no", "title", "verified", "tentative", "flagged", F.round("score", 3).alias("score"))))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).alias(x)
    g = chapters.agg(c.alias("c"), total("verified"), total("tentative"), total("flagged"), F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 3).alias("accuracy_score"))
    summary = F.struct((F.col("verified") + F.col("tentative") + F.col("flagged")).alias("total_claims"), "verified", "tentative", "flagged", "accuracy_score")
    return g.select(F.to_json(F.struct(F.lit(topic).alias("topic"), summary.alias("summary"), F.transform("c", lambda x: x.dropFields("no")).alias("chapters"))).alias("json"))


def gap_list(topic: str, thin: DataFrame, missing: DataFrame, unused: DataFrame) -> DataFrame:
    """seq and node: what the next harvest should look for, each once. thin: no, title; missing: no, topics (array); unused: file,
    hits (array). Two nodes a thin chapter, two for each of a chapter's first four missing topics, three hits of ten files."""
    two = lambda c, *ends: F.array(*[F.concat(F.lit(f"{topic} "), c, F.lit(e)) for e in ends])
    a = thin.select(F.lit(1).alias("kind"), F.col("no").cast("string").alias("k"), F.posexplode(two(F.lower("title"), " complete guide", " techniques procedures")).alias("p", "node"))
    b = missing.select(F.lit(2).alias("kind"), F.lpad(F.col("no").cast("string"), 9, "0").alias("k"), F.posexplode(F.flatten(F.transform(F.slice("topics", 1, TOPICS_A_CHAPTER), lambda t: two(t, "", " step by step")))).alias("p", "node"))
    first = unused.orderBy("file").limit(UNUSED_FILES)
    c = first.select(F.lit(3).alias("kind"), F.col("file").alias("k"), F.posexplode(F.transform(F.slice(F.array_sort("hits"), 1, HITS_A_FILE), lambda h: F.concat(F.lit(f"{topic} "), h, F.lit(" practical guide")))).alias("p", "node"))
    a = a.withColumn("k", F.lpad("k", 9, "0"))
    rows = a.unionByName(b).unionByName(c).withColumn("node", F.btrim("node")).where("node <> ''")
    return rows.groupBy("node").agg(F.min(F.struct("kind", "k", "p")).alias("seq"))


def gap_report(topic: str, coverage: DataFrame, nodes: DataFrame) -> DataFrame:
    """coverage: one row (words, used, unused, thin, missing); nodes: of gap_list."""
    md = coverage.select(F.format_string("- Total words: %d\n- Source files used: %d\n- Source files unused: %d\n- Thin chapters: %d\n- Missing topics: %d", "words", "used", "unused", "thin", "missing").alias("md"))
    return document(f"{topic.replace('_', ' ').title()} — Gap Report", [("Coverage", md, None), ("Gap Nodes for Next Harvest Cycle", bullets(nodes, F.concat(F.lit("`"), "node", F.lit("`")), ["seq"]), "*None.*")])


def index_report(terms: DataFrame, most: int = 5) -> DataFrame:
    """An index: terms (term, chapter) sorted under their first letters, each with its first five chapters."""
    t = terms.distinct().groupBy("term").agg(F.slice(F.array_sort(F.collect_list("chapter")), 1, most).alias("c"))
    line = F.concat(F.lit("**"), "term", F.lit("** — "), F.array_join(F.transform("c", lambda x: x.cast("string")), ", "))
    g = t.groupBy(F.upper(F.left("term", F.lit(1))).alias("letter")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("term").alias("k"), line.alias("line")))), lambda x: x["line"]).alias("lines"))
    out = g.agg(F.array_sort(F.collect_list(F.struct("letter", "lines"))).alias("g"))
    body = F.array_join(F.transform("g", lambda x: F.concat(F.lit("### "), x["letter"], F.lit("\n\n"), F.array_join(x["lines"], "\n"))), "\n\n")
    return out.select(F.concat(F.lit("# Index\n\n"), body).alias("markdown"))


def checklist(claims: DataFrame, most: int = 50) -> DataFrame:
    """A sample of claims (claim_id, text, source) to verify by hand, in the order of a hash."""
    top = claims.withColumn("k", F.xxhash64("claim_id")).orderBy("k", "claim_id").limit(most)
    return document("Verification Sample", [("Claims", bullets(top, F.concat(F.lit("[ ] "), "text", F.lit(" — `"), "source", F.lit("`")), ["k", "claim_id"]), "*None.*")])


def write_text(report: DataFrame, folder: str) -> None:
    """A report of one text column as a file in a folder."""
    report.select(report[report.columns[0]].alias("value")).coalesce(1).write.mode("overwrite").text(folder)


def write_timeline(events: DataFrame, folder: str) -> None:
    """All events as JSON lines, those of a run together and in order."""
    events.repartitionByRange("run_id", "seq").sortWithinPartitions("run_id", "seq").write.mode("overwrite").json(folder)


def append_claims(spark: SparkSession, new: DataFrame, folder: str) -> DataFrame:
    """Appends claims of files that have none yet; a second run adds nothing. Returns what was added."""
    old = _existing(spark, folder, "source_file")
    added = stored(new if old is None else new.join(old, "source_file", "left_anti").select(*new.columns), "claims")
    added.write.mode("append").parquet(folder)
    return added


def _existing(spark: SparkSession, folder: str, key: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder).select(key).distinct()
    except AnalysisException:
        return None


def append_fingerprints(new: DataFrame, folder: str) -> None:
    """fp as lines of 16 hexadecimal digits, in the order of seq."""
    new.orderBy("seq").select(F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("value")).write.mode("append").text(folder)
