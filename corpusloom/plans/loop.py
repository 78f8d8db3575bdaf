"""The harvest loop's decisions as queries: node states, gap nodes put back, stop rules, saved files, books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import numbers as N
from ..functions import records
from ..functions import text as X
from ..functions.lists import SKIP_DOMAINS
from ..operators import frontier, probes
from ..registry import query
from ..sources.scratch import stored
from ..sources.tables import load
from .corpus import WORDS

#: Stand-in: an event's type is a transition of the node (user, day).
GROUNDED, STALLED, GAP = "purchase", "error", "signup"
_NODES = f"nodes AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, bool_or(event_type = '{GROUNDED}') AS g, bool_or(event_type = '{STALLED}') AS s, bool_or(event_type = '{GAP}') AS gap, count(DISTINCT event_id) FILTER (event_type = '{GROUNDED}') AS files FROM events GROUP BY ALL)"


def node_flags(events: DataFrame) -> DataFrame:
    """One row a node: whether it was ever grounded, stalled or asked for by gap analysis, and its files. Flags are
    combined on the map side, so a node with a third of all events costs a row a task."""
    kind = F.col("event_type")
    e = events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type")
    files = F.count(F.when(kind == GROUNDED, F.col("event_id")))
    return e.groupBy("user_id", "day").agg(F.bool_or(kind == GROUNDED).alias("g"), F.bool_or(kind == STALLED).alias("s"), F.bool_or(kind == GAP).alias("gap"), files.alias("files"))


@query(f"WITH {_NODES} SELECT user_id, day, CASE WHEN g THEN 'grounded' WHEN s THEN 'stalled' ELSE 'pending' END AS status, CAST(files AS BIGINT) AS files FROM nodes")
def node_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node once grounded stays so; a stall counts only for the others."""
    status = F.when(F.col("g"), "grounded").when(F.col("s"), "stalled").otherwise("pending")
    return node_flags(load(spark, sf_dir, "events")).select("user_id", "day", status.alias("status"), "files")


@query(f"""WITH {_NODES}, known AS (SELECT user_id, day, CASE WHEN g THEN 'grounded' ELSE 'stalled' END AS status FROM nodes WHERE g OR s), gaps AS (SELECT user_id, day FROM nodes WHERE gap)
SELECT user_id, day, CASE WHEN k.status IS NULL OR (k.status = 'stalled' AND g.user_id IS NOT NULL) THEN 'pending' ELSE k.status END AS status, CAST(CASE WHEN k.status IS NULL THEN 2 WHEN k.status = 'stalled' AND g.user_id IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS bonus
FROM known k FULL JOIN gaps g USING (user_id, day)""")
def gap_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap nodes that are new become pending with 2 points, stalled ones are reopened with 1, others keep their state.
    Known nodes and gaps come from one grouping, so the full join of the two needs no shuffle of its own."""
    n = node_flags(load(spark, sf_dir, "events")).where("g OR s OR gap")
    new, reopened = ~F.col("g") & ~F.col("s"), ~F.col("g") & F.col("s") & F.col("gap")
    status = F.when(new | reopened, "pending").when(F.col("g"), "grounded").otherwise("stalled")
    return n.select("user_id", "day", status.alias("status"), F.when(new, 2).when(reopened, 1).otherwise(0).alias("bonus"))


#: Usable from this score; the least rise that counts as progress; the cycles a run may take.
USABLE, LEAST_RISE, MAX_CYCLES = 0.74, 0.05, 10
_RULES = f"""d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(avg(value) / 200, 4) AS score, count(*) FILTER (event_type = 'view') AS new_files, count(*) FILTER (event_type = '{GAP}') AS gaps FROM events GROUP BY ALL),
c AS (SELECT *, row_number() OVER w AS cycle, lag(score) OVER w AS before FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
f AS (SELECT user_id, cycle, CASE WHEN score >= {USABLE} THEN 'usable' WHEN cycle >= {MAX_CYCLES} THEN 'max cycles' WHEN cycle > 1 AND new_files = 0 THEN 'no new files' WHEN round(score - before, 4) < {LEAST_RISE} THEN 'plateau' WHEN gaps = 0 THEN 'no gap nodes' END AS rule FROM c)"""


def stop_rule(score: Column, before: Column, cycle: Column, new_files: Column, gaps: Column) -> Column:
    """The first rule that ends the loop after a cycle, null to go on."""
    return (
        F.when(score >= USABLE, "usable").when(cycle >= MAX_CYCLES, "max cycles").when((cycle > 1) & (new_files == 0), "no new files")
        .when(N.rounded(score - before, 4) < LEAST_RISE, "plateau").when(gaps == 0, "no gap nodes")
    )


@query(f"WITH {_RULES} SELECT user_id, CAST(min(cycle) AS INTEGER) AS cycle, arg_min(rule, cycle) AS rule FROM f WHERE rule IS NOT NULL GROUP BY user_id")
def stop_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each run stops and why; a run is a user, a cycle a day."""
    kind, w = F.col("event_type"), Window.partitionBy("user_id").orderBy("day")
    e = load(spark, sf_dir, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_id", "event_type", "value")
    e = N.running(e, "value", ["user_id", "day"], ["ts", "event_id"])
    d = e.groupBy("user_id", "day").agg(N.rounded(N.last_mean("value") / 200, 4).alias("score"), F.count_if(kind == "view").alias("new_files"), F.count_if(kind == GAP).alias("gaps"))
    c = d.select("user_id", "score", "new_files", "gaps", F.row_number().over(w).alias("cycle"), F.lag("score").over(w).alias("before"))
    f = c.select("user_id", "cycle", stop_rule(*[F.col(x) for x in ("score", "before", "cycle", "new_files", "gaps")]).alias("rule")).where("rule IS NOT NULL")
    return f.groupBy("user_id").agg(F.min("cycle").alias("cycle"), F.min_by("rule", "cycle").alias("rule"))


_NAME = "'VOL_' || replace(regexp_replace(node, '[^a-zA-Z0-9 ]', '', 'g'), ' ', '_') || '_' || regexp_replace(right(url, 12), '[^a-zA-Z0-9]', '', 'g') || '.txt'"


def vault_name(node: Column, key: Column) -> Column:
    """File of a saved text: the node's letters, digits and blanks, and those of the last 12 characters of its id."""
    safe = F.replace(F.regexp_replace(node, "[^a-zA-Z0-9 ]", ""), F.lit(" "), F.lit("_"))
    return F.concat(F.lit("VOL_"), safe, F.lit("_"), F.regexp_replace(F.right(key, F.lit(12)), "[^a-zA-Z0-9]", ""), F.lit(".txt"))


@query(f"WITH p AS (SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(url, ''), '^https?://([^/?#]+)', 1) AS node FROM pages), n AS (SELECT page_id, {_NAME} AS file FROM p) SELECT file, max(page_id) AS page_id, CAST(count(*) AS BIGINT) AS writes FROM n GROUP BY file")
def vault_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved files where the last write of a name stays, and how often each was written."""
    p = load(spark, sf_dir, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    named = p.select("page_id", vault_name(F.regexp_extract("url", r"^https?://([^/?#]+)", 1), F.col("url")).alias("file"))
    return named.groupBy("file").agg(F.max("page_id").alias("page_id"), F.count("*").alias("writes"))


def assemble(chapters: DataFrame, book: str, no: str, title: str, body: str) -> DataFrame:
    """A book for each group: a title, contents with links, then numbered chapters parted by rules, and a footer of counts.
    A book has the chapters of a plan, so its group is bounded by the plan."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(no).alias("n"), F.col(title).alias("title"), X.strip_markers(F.col(body)).alias("body"))))
    b = chapters.groupBy(book).agg(F.count("*").alias("chapters"), F.sum(X.word_count(F.col(body))).alias("words"), parts.alias("p"))
    number = lambda i: (i + 1).cast("string")
    contents = F.array_join(F.transform("p", lambda x, i: F.concat(number(i), F.lit(". ["), x["title"], F.lit("](#"), X.slugify(x["title"]), F.lit(")"))), "\n")
    whole = F.array_join(F.transform("p", lambda x, i: F.concat(F.lit("## "), number(i), F.lit(". "), x["title"], F.lit("\n\n"), x["body"])), "\n\n---\n\n")
    footer = F.concat(F.lit("*~"), F.col("words").cast("string"), F.lit(" words | "), F.col("chapters").cast("string"), F.lit(" chapters*"))
    return b.select(book, "chapters", F.concat_ws("\n\n", F.concat(F.lit("# "), F.col(book).cast("string"), F.lit(" — Complete Technical Guide")), F.lit("## Table of Contents"), contents, F.lit("---"), whole, F.lit("---"), footer).alias("markdown"))


_NL = "chr(10) || chr(10)"
_BODY = r"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\\s*\\[C\\d+(?:[, ]+C\\d+)*\\]', '', 'g'), '[ \\t]{2,}', ' ', 'g'), ' +([.,;:!?])', '\\1', 'g')".replace("\\\\", "\\")


@query(f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, {_BODY} AS body, len({WORDS("coalesce(text, '')")}) AS words FROM conversations WHERE conv_id IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, body) AS i FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS chapters, md5('# ' || conv_id || ' — Complete Technical Guide' || {_NL} || '## Table of Contents' || {_NL} || string_agg(i || '. [' || role || '](#' || role || ')', chr(10) ORDER BY i) || {_NL} || '---' || {_NL} || string_agg('## ' || i || '. ' || role || {_NL} || body, {_NL} || '---' || {_NL} ORDER BY i) || {_NL} || '---' || {_NL} || '*~' || CAST(sum(words) AS BIGINT) || ' words | ' || count(*) || ' chapters*') AS digest FROM n GROUP BY conv_id""")
def book_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books of conversations: a turn is a chapter; claim markers are taken out as the book is written."""
    c = load(spark, sf_dir, "conversations").where("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return assemble(c, "conv_id", "turn", "role", "text").select("conv_id", "chapters", F.md5("markdown").alias("digest"))


@query("SELECT item_id, '[C' || row_number() OVER (PARTITION BY length(text) ORDER BY item_id) || '] ' || left(text, 200) || ' — [' || left('item-' || item_id || '.txt', 30) || ']' AS line FROM benchmark WHERE text IS NOT NULL")
def claims_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims as numbered lines of a prompt; a chapter's claims are those of one length here."""
    n = F.row_number().over(Window.partitionBy(F.length("text")).orderBy("item_id")).cast("string")
    file = F.left(F.concat(F.lit("item-"), F.col("item_id").cast("string"), F.lit(".txt")), F.lit(30))
    line = F.concat(F.lit("[C"), n, F.lit("] "), F.left("text", F.lit(200)), F.lit(" — ["), file, F.lit("]"))
    return load(spark, sf_dir, "benchmark").where("text IS NOT NULL").select("item_id", line.alias("line"))


_SPEC = f"(?i:{M.NUMBER_UNIT})|(?i:{M.YEAR})|{M.STANDARD}"


def check_markers(chapters: DataFrame, claims: DataFrame, specific: str = _SPEC) -> DataFrame:
    """Chapters checked by their markers: a marker of a claim that the chapter was given is verified, or tentative where the
    claim's source has low trust; another marker is flagged, and so is a sentence of 25 characters or more that names a
    specific value and has no marker. Chapters without markers have no row. chapters: chapter, content; claims: chapter, n, low."""
    ids = chapters.select("chapter", F.explode(F.array_distinct(X.marker_ids(F.col("content")))).alias("n"))
    held = ids.join(claims, ["chapter", "n"], "left").select("chapter", F.when(F.col("low").isNull(), "flagged").when(F.col("low"), "tentative").otherwise("verified").alias("kind"))
    bare = chapters.where(F.size(X.marker_ids(F.col("content"))) > 0).select("chapter", F.explode(X.sentences(F.col("content"))).alias("s"))
    bare = bare.where((F.length(F.btrim("s")) >= 25) & ~F.col("s").rlike(X.MARKER) & F.col("s").rlike(specific)).select("chapter", F.lit("flagged").alias("kind"))
    k = F.col("kind")
    out = held.unionByName(bare).groupBy("chapter").agg(*[F.count_if(k == x).alias(x) for x in ("verified", "tentative", "flagged")])
    return out.withColumn("score", F.round((F.col("verified") + 0.5 * F.col("tentative")) / (F.col("verified") + F.col("tentative") + F.col("flagged")), 6))


_MARKED = """x AS (SELECT doc_id, list_transform(string_split(regexp_replace(text, '([.!?])\\s+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda s, i: CASE i % 3 WHEN 1 THEN regexp_replace(s, '([.!?])$', ' [C' || i || ']\\1')
        WHEN 2 THEN s ELSE regexp_replace(s, '([.!?])$', ' [C' || (i - 1) || ', C' || (2 * i) || ']\\1') END) AS s FROM documents),
    ch AS (SELECT doc_id AS chapter, array_to_string(s, ' ') AS content FROM x),
    cl AS (SELECT doc_id AS chapter, n, (n + toxic) % 2 = 0 AS low FROM labels, unnest(range(1, 9)) AS u(n) WHERE n <= 4 + 4 * quality)"""


@query(f"""WITH {_MARKED}, m AS (SELECT DISTINCT chapter, CAST(unnest(flatten(list_transform(regexp_extract_all(content, '\\[C\\d+(?:[, ]+C\\d+)*\\]'), lambda x: regexp_extract_all(x, '\\d+')))) AS INTEGER) AS n FROM ch),
s AS (SELECT chapter, unnest(string_split(regexp_replace(content, '([.!?])\\s+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS s FROM ch WHERE chapter IN (SELECT chapter FROM m)),
k AS (SELECT chapter, CASE WHEN low IS NULL THEN 'flagged' WHEN low THEN 'tentative' ELSE 'verified' END AS kind FROM m LEFT JOIN cl USING (chapter, n) UNION ALL SELECT chapter, 'flagged' FROM s WHERE length(s) >= 25 AND NOT regexp_matches(s, '\\[C\\d+') AND regexp_matches(s, '{_SPEC}'))
SELECT chapter, count(*) FILTER (kind = 'verified') AS verified, count(*) FILTER (kind = 'tentative') AS tentative, count(*) FILTER (kind = 'flagged') AS flagged, round((count(*) FILTER (kind = 'verified') + 0.5 * count(*) FILTER (kind = 'tentative')) / count(*), 6) AS score FROM k GROUP BY chapter""")
def marker_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters whose sentences have markers, two of three; a labelled document was given four claims or eight."""
    d = load(spark, sf_dir, "documents").select("doc_id", X.sentences(F.col("text")).alias("s"))
    before_end = lambda s, mark: F.regexp_replace(s, r"([.!?])$", F.concat(F.lit(" [C"), mark, F.lit("]$1")))

    def marked(s, i):
        n = i + 1
        both = F.concat(i.cast("string"), F.lit(", C"), (2 * n).cast("string"))
        return F.when(n % 3 == 1, before_end(s, n.cast("string"))).when(n % 3 == 2, s).otherwise(before_end(s, both))

    chapters = d.select(F.col("doc_id").alias("chapter"), F.array_join(F.transform("s", marked), " ").alias("content"))
    n = F.explode(F.sequence(F.lit(1), (4 + 4 * F.col("quality")).cast("int"))).alias("n")
    claims = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("chapter"), "toxic", n).select("chapter", "n", ((F.col("n") + F.col("toxic")) % 2 == 0).alias("low"))
    return check_markers(chapters, claims)


_FOUND = """f AS (SELECT CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS cycle, user_id AS node, event_type, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS identifier FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY cycle, node ORDER BY event_id) AS rank, event_type IN ('purchase', 'view') AS good FROM f WHERE identifier IS NOT NULL)"""


def _attempts(cycle: int, flags: str, skips: str) -> str:
    return f"""m{cycle} AS (SELECT n.*, h.identifier IS NOT NULL AS high, k.identifier IS NOT NULL AS skip FROM n LEFT JOIN {flags} h ON h.identifier = n.identifier LEFT JOIN {skips} k ON k.identifier = n.identifier WHERE cycle = {cycle}),
    r{cycle} AS (SELECT *, CASE WHEN max(CAST(high AND rank <= 8 AS INTEGER)) OVER (PARTITION BY node) = 1 THEN 8 ELSE 5 END AS reach, coalesce(sum(CAST(good AND NOT skip AS INTEGER)) OVER (PARTITION BY node ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m{cycle}),
    a{cycle} AS (SELECT cycle, node, rank, identifier, good AS saved FROM r{cycle} WHERE rank <= reach AND before < 3 AND NOT skip)"""


@query(f"""WITH {_FOUND}, none AS (SELECT CAST(NULL AS BIGINT) AS identifier WHERE false), {_attempts(1, "none", "none")},
    flag AS (SELECT identifier FROM a1 GROUP BY identifier HAVING count(*) >= 2 AND count(*) FILTER (saved) >= 1), bad AS (SELECT identifier FROM a1 GROUP BY identifier HAVING count(*) FILTER (saved) = 0), {_attempts(2, "flag", "bad")}
    SELECT CAST(cycle AS INTEGER) AS cycle, node, CAST(rank AS INTEGER) AS rank, identifier, saved FROM a1 UNION ALL SELECT CAST(cycle AS INTEGER), node, CAST(rank AS INTEGER), identifier, saved FROM a2""")
def harvest_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cycles of searches: what the first one learns about identifiers (high value, or never saved) steers the second."""
    e = load(spark, sf_dir, "events").select(F.when(F.dayofmonth("ts") <= 15, 1).otherwise(2).alias("cycle"), F.col("user_id").alias("node"), "event_id", F.get_json_object("props", "$.k").cast("long").alias("identifier"), F.col("event_type").isin("purchase", "view").alias("saved"))
    rank = F.row_number().over(Window.partitionBy("cycle", "node").orderBy("event_id"))
    found = e.where("identifier IS NOT NULL").withColumns({"rank": rank, "source": F.lit("events")})
    empty = spark.createDataFrame([], "identifier long, high_value boolean")
    first = stored(frontier.cycle(found.where("cycle = 1"), empty, empty), "cycle")
    known = frontier.known_sources(first)
    second = frontier.cycle(found.where("cycle = 2"), known, known.where("saved = 0"))
    return first.unionByName(second).select("cycle", "node", "rank", "identifier", "saved")


@query("WITH c AS (SELECT doc_id AS claim_id, regexp_matches(text, '[0-9]') AS specific, md5(doc_id || ':7') AS key FROM documents), t AS (SELECT *, unnest(CASE WHEN specific THEN [0, 1] ELSE [1] END) AS turn FROM c) SELECT claim_id, specific, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (ORDER BY turn, key, claim_id) AS i FROM t) WHERE i <= 300")
def specifics_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300 documents for a check by hand, those with numbers first."""
    return probes.specifics_first(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("claim_id"), F.col("text").rlike("[0-9]").alias("specific")), 300, 7)


_SKIPPED = "[" + ", ".join(f"'{d}'" for d in SKIP_DOMAINS) + "]"


@query(f"""WITH t AS (SELECT page_id, coalesce(url, '') || ' ' || coalesce(html, '') || CASE page_id % 4 WHEN 0 THEN ' https://www.youtube.com/watch?v=' || page_id WHEN 1 THEN ' http://lib.example.org/' || page_id % 50 || ').' WHEN 2 THEN ' https://netflix.com/' || page_id ELSE ' http://lib.example.xyz/' || page_id END AS t FROM pages),
    u AS (SELECT page_id, unnest(list_filter(list_transform(regexp_extract_all(t, '{X.URL.replace("'", "''")}'), lambda u: regexp_replace(u, '[.,;:!?]+$', '')), lambda u: length(u) BETWEEN 12 AND 500)) AS url FROM t),
    d AS (SELECT page_id, url, ltrim(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), 'w.') AS domain FROM u WHERE regexp_matches(url, '(?i)\\.(com|org|net|edu|gov|int|info|io|co|uk|ca)(/|$|\\?|#)'))
    SELECT url, domain, min(page_id) AS first FROM d WHERE len(list_filter({_SKIPPED}, lambda s: contains(domain, s))) = 0 GROUP BY url, domain""")
def cited_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages (and one written from each page's number) that are worth fetching: of a known ending, and not of a domain
    that has a connector of its own or nothing to read. A domain to skip is looked for anywhere in a host."""
    n = F.col("page_id")
    extra = F.when(n % 4 == 0, F.concat(F.lit(" https://www.youtube.com/watch?v="), n.cast("string"))).when(n % 4 == 1, F.concat(F.lit(" http://lib.example.org/"), (n % 50).cast("string"), F.lit(").")))
    extra = extra.when(n % 4 == 2, F.concat(F.lit(" https://netflix.com/"), n.cast("string"))).otherwise(F.concat(F.lit(" http://lib.example.xyz/"), n.cast("string")))
    pages = load(spark, sf_dir, "pages").select("page_id", F.concat(F.coalesce("url", F.lit("")), F.lit(" "), F.coalesce("html", F.lit("")), extra).alias("t"))
    return records.worth_fetching(pages.select("page_id", F.explode(X.urls(F.col("t"))).alias("url"))).groupBy("url", "domain").agg(F.min("page_id").alias("first"))
