"""Admission gates, text metrics, fingerprints and duplicates over documents and pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import HTML_TAGS, LEXICON, SHORT_LIMIT, SOURCES, TITLE_BLOCKED
from ..operators import gates, overlaps, simhash
from ..operators.verdicts import Verdicts, unclassified
from ..registry import query
from ..sources.scratch import base_folder, stored
from ..sources.tables import load, vault
from ..streaming import dedup

Q = "'"
CONFIG = "config(source, source_name, min_hits, html_gate, min_length, tiers, low_trust, is_reference) AS (VALUES " + ", ".join(f"('src{i}', '{n}', {h}, {g}, {m}, '{t}', {lo}, {r})" for i, (n, h, g, m, t, lo, r) in enumerate(SOURCES)) + ")"
VAULT = f"""{CONFIG}, vault AS (SELECT doc_id, text, lang, d.source, coalesce(source_name, 'recovered') AS source_name, coalesce(min_hits, 2) AS min_hits, coalesce(html_gate, false) AS html_gate,
    coalesce(min_length, 2500) AS min_length, coalesce(low_trust, false) AS low_trust, coalesce(is_reference, false) AS is_reference FROM documents d LEFT JOIN config c ON d.source = c.source)"""
LEX = "[" + ", ".join(f"'{t}'" for t in LEXICON) + "]"
TAGS = "[" + ", ".join(f"'{t}'" for t in HTML_TAGS) + "]"
WORDS = lambda t: f"list_filter(string_split_regex({t}, '[ \\t\\n\\r\\f\\x0B]+'), lambda w: w <> '')"
DENSITY = lambda t: f"len(list_filter({LEX}, lambda t: contains(lower({t}), t)))"
HTML = lambda t: f"len(list_filter({TAGS}, lambda t: contains(lower(substr({t}, 1, 2000)), t))) > 0"
RATIO = "length(regexp_replace(text, '\\P{L}', '', 'g')) / length(text)"


@query(f"WITH {VAULT} SELECT source_name, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (low_trust) AS BIGINT) AS low FROM vault GROUP BY source_name")
def source_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).groupBy("source_name").agg(F.count("*").alias("n"), F.count_if("low_trust").alias("low"))


@query(f"WITH {VAULT} SELECT source_name, lang, CAST(count(*) AS BIGINT) AS n FROM vault GROUP BY GROUPING SETS ((), (source_name), (lang))")
def type_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vault(spark, sf_dir)
    return v.groupingSets([[], ["source_name"], ["lang"]], "source_name", "lang").agg(F.count("*").alias("n")).select("source_name", "lang", "n")


@query(f"WITH {VAULT} SELECT CAST(floor(100 * (count(*) FILTER (low_trust)) / greatest(count(*), 1)) AS BIGINT) AS low_percent FROM vault")
def low_trust_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).agg(F.floor(100 * F.count_if("low_trust") / F.greatest(F.count("*"), F.lit(1))).alias("low_percent"))


@query(f"WITH {VAULT} SELECT round(coalesce(avg(CASE WHEN is_reference THEN 1.0 ELSE 0.0 END), 0.0), 6) AS share FROM vault")
def reference_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).agg(F.round(F.coalesce(F.avg(F.col("is_reference").cast("double")), F.lit(0.0)), 6).alias("share"))


@query(f"SELECT page_id AS id, {HTML('html')} AS looks_html FROM pages UNION ALL SELECT doc_id, {HTML('text')} FROM documents")
def html_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, d = load(spark, sf_dir, "pages"), load(spark, sf_dir, "documents")
    return p.select(F.col("page_id").alias("id"), X.looks_like_html(F.col("html")).alias("looks_html")).unionAll(d.select("doc_id", X.looks_like_html(F.col("text"))))


@query(f"SELECT doc_id, round({RATIO}, 6) AS ratio, {RATIO} < 0.5 AS rejected FROM documents")
def letter_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = X.letter_ratio(F.col("text"))
    return load(spark, sf_dir, "documents").select("doc_id", F.round(r, 6).alias("ratio"), (r < 0.5).alias("rejected"))


@query(f"WITH {VAULT} SELECT source_name, CAST(count(*) FILTER (length(text) < min_length) AS BIGINT) AS too_short, CAST(count(*) AS BIGINT) AS n FROM vault GROUP BY source_name")
def length_floor_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).groupBy("source_name").agg(F.count_if(F.length("text") < F.col("min_length")).alias("too_short"), F.count("*").alias("n"))


def _ocr(t: str) -> str:
    w = WORDS(t)
    lines = f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '')"
    return f"""{{'n': len({w}), 'mean_length': list_sum(list_transform({w}, lambda w: length(w))) / len({w}),
        'real_share': len(list_filter({w}, lambda w: length(w) >= 2 AND length(regexp_replace(w, '\\P{{L}}', '', 'g')) / length(w) >= 0.6)) / len({w}), 'short_lines': len(list_filter({lines}, lambda x: length(x) < 15)) / len({lines})}}"""


@query(f"WITH m AS (SELECT doc_id, {_ocr('text')} AS m FROM documents) SELECT doc_id, CAST(m.n AS INTEGER) AS n, round(m.mean_length, 6) AS mean_length, round(m.real_share, 6) AS real_share, round(m.short_lines, 6) AS short_lines FROM m")
def ocr_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = load(spark, sf_dir, "documents").select("doc_id", X.ocr_metrics(F.col("text")).alias("m"))
    return m.select("doc_id", F.col("m.n").alias("n"), *[F.round(f"m.{c}", 6).alias(c) for c in ("mean_length", "real_share", "short_lines")])


OCR_SQL = f"""parts AS (SELECT doc_id, length(text) AS n, unnest([substr(text, 2001, 6000),
        substr(text, CAST(CASE WHEN length(text) // 2 < 3000 THEN length(text) + length(text) // 2 - 3000 ELSE length(text) // 2 - 3000 END + 1 AS BIGINT), CAST(least(length(text) // 2 + 3000, length(text)) - CASE WHEN length(text) // 2 < 3000 THEN length(text) + length(text) // 2 - 3000 ELSE length(text) // 2 - 3000 END AS BIGINT)),
        substr(text, CAST(greatest(length(text) - 5999, 1) AS BIGINT), 6000)]) AS t FROM documents WHERE length(text) >= 3000),
    scored AS (SELECT doc_id, {_ocr('t')} AS m FROM parts),
    ocr AS (SELECT doc_id, count(*) FILTER (m.n >= 50 AND (m.mean_length < 3 OR m.real_share < 0.55 OR m.short_lines > 0.7)) >= 2 AS garbage FROM scored GROUP BY doc_id)"""


@query(f"WITH {OCR_SQL} SELECT doc_id, coalesce(garbage, false) AS garbage FROM documents LEFT JOIN ocr USING (doc_id)")
def ocr_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", X.ocr_garbage(F.col("text")).alias("garbage"))


@query(f"SELECT doc_id, CAST({DENSITY('text')} AS INTEGER) AS density FROM documents")
def density_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", X.density(F.col("text"), LEXICON).alias("density"))


WINDOWED = f"""each AS (SELECT doc_id, length(text) AS n, [{DENSITY('text')}] AS one, [{DENSITY('substr(text, 1, 5000)')}, {DENSITY('substr(text, CAST(length(text) // 2 - 2499 AS BIGINT), 5000)')}, {DENSITY('substr(text, CAST(length(text) - 4999 AS BIGINT), 5000)')}] AS three FROM documents),
    windowed AS (SELECT doc_id, CASE WHEN n <= 15000 THEN one[1] WHEN len(list_filter(three, lambda x: x > 0)) >= 2 THEN list_sum(three) ELSE 0 END AS density FROM each)"""


@query(f"WITH {WINDOWED} SELECT doc_id, CAST(density AS INTEGER) AS density FROM windowed")
def density_multi_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", X.window_density(F.col("text"), LEXICON).alias("density"))


def _fallback() -> str:
    keys = "CASE lang " + " ".join(f"WHEN '{k}' THEN [{', '.join(Q + t + Q for t in v)}]" for k, v in gates.TOPIC_KEYWORDS.items()) + " ELSE [] END"
    return f"len(list_filter({keys}, lambda k: contains(lower(text), k)))"


@query(f"WITH {VAULT}, {WINDOWED} SELECT v.doc_id, density >= min_hits OR {_fallback()} >= 2 AS dense FROM vault v JOIN windowed USING (doc_id)")
def density_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).select("doc_id", gates.dense_enough().alias("dense"))


@query(f"SELECT doc_id, round((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 / greatest(len({WORDS('text')}), 1) * 100, 6) AS density FROM documents")
def topic_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.round(X.topic_density(F.col("text"), "the"), 6).alias("density"))


@query(f"SELECT doc_id, CAST(len({WORDS('text')}) AS INTEGER) AS words FROM documents")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", X.word_count(F.col("text")).alias("words"))


@query("SELECT doc_id, CAST(len(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r\\f]+([A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS INTEGER) AS sentences FROM documents")
def sentence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.size(X.sentences(F.col("text"))).alias("sentences"))


@query(f"WITH w AS (SELECT doc_id, {WORDS('text')} AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(len(w) / 300) AS BIGINT))) AS chunk FROM w) SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, md5(array_to_string(list_slice(w, chunk * 300 + 1, chunk * 300 + 300), ' ')) AS digest FROM c")
def word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.chunks(F.col("text"))).alias("chunk", "t")).select("doc_id", "chunk", F.md5("t").alias("digest"))


BITS_SQL = """w AS (SELECT doc_id, lang AS topic, encode(substr(text, CAST(i AS BIGINT), 6)) AS b FROM (SELECT doc_id, lang, text, unnest(range(1, length(text) - 4)) AS i FROM documents WHERE length(text) >= 2500)),
    x AS (SELECT doc_id, topic, octet_length(b) AS m, list_transform(range(1, octet_length(b) + 1), lambda k: CAST('0x' || substr(hex(b), CAST(2 * k - 1 AS BIGINT), 2) AS BIGINT)) AS v FROM w),
    h AS (SELECT doc_id, topic, ((m + list_sum(list_transform(range(1, m + 1), lambda k: v[k] * (m - k + 1)))) % 65521) * 65536 + (1 + list_sum(v)) % 65521 AS h FROM x),
    bit AS (SELECT doc_id, topic, count(*) AS n, list_transform(range(0, 32), lambda i: i) AS i, [""" + ", ".join(f"sum((CAST(h AS BIGINT) >> {i}) & 1)" for i in range(32)) + """] AS v FROM h GROUP BY doc_id, topic)"""


FP_SQL = f"{BITS_SQL}, print AS (SELECT doc_id, topic, CAST(list_sum(list_transform(range(0, 32), lambda i: CASE WHEN 2 * v[i + 1] > n THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT) AS high, CAST(list_sum(list_transform(range(0, 32), lambda i: CASE WHEN 2 * (CASE WHEN i % 2 = 0 THEN n - v[i + 1] ELSE v[i + 1] END) > n THEN 1::BIGINT << i ELSE 0 END)) AS BIGINT) AS low FROM bit)"


@query(f"WITH {FP_SQL} SELECT doc_id, high, low FROM print")
def simhash_fp(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = simhash.fingerprints(load(spark, sf_dir, "documents"))
    return p.select("doc_id", F.shiftrightunsigned("fp", 32).alias("high"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"))


@query(f"""WITH {FP_SQL}, f AS (SELECT DISTINCT topic, (CASE WHEN high >= 2147483648 THEN high - 4294967296 ELSE high END) * 4294967296 + low AS fp FROM print)
    SELECT a.topic, a.fp AS a, b.fp AS b FROM f a JOIN f b ON a.topic = b.topic AND a.fp < b.fp AND bit_count(xor(a.fp, b.fp)) <= 4""")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_pairs(simhash.fingerprints(load(spark, sf_dir, "documents")))


GREEDY = """r AS (SELECT topic, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS fps, CAST([] AS BIGINT[]) AS ids FROM (SELECT DISTINCT topic FROM o)
        UNION ALL SELECT r.topic, o.i, CASE WHEN len(list_filter(fps, lambda x: bit_count(xor(x, o.fp)) <= 4)) > 0 THEN fps ELSE list_append(fps, o.fp) END, CASE WHEN len(list_filter(fps, lambda x: bit_count(xor(x, o.fp)) <= 4)) > 0 THEN ids ELSE list_append(ids, o.doc_id) END
        FROM r JOIN o ON o.topic = r.topic AND o.i = r.i + 1),
    kept AS (SELECT topic, unnest(ids) AS doc_id, unnest(fps) AS fp FROM r WHERE i = (SELECT max(i) FROM o WHERE o.topic = r.topic))"""


def _greedy_sql(order: str) -> str:
    """One row after another in the given order, with the list of fingerprints kept so far."""
    return f"""WITH RECURSIVE {FP_SQL}, f AS (SELECT p.doc_id, p.topic, strlen(d.text) AS size, (CASE WHEN high >= 2147483648 THEN high - 4294967296 ELSE high END) * 4294967296 + low AS fp FROM print p JOIN documents d USING (doc_id)),
    o AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY {order}) AS i FROM f), {GREEDY}
    SELECT topic, doc_id, CAST(fp AS BIGINT) AS fp FROM kept UNION ALL SELECT lang, doc_id, NULL FROM documents WHERE length(text) < 2500"""


def judge(prompt: str) -> str:
    """A stand-in for a model, by the letters of what it reads."""
    n = prompt.split("\n\n", 1)[1].count("e") % 7
    return ["", "No.", "Yes"][min(n, 2)]


_MARKERS = f"CASE WHEN density < min_hits THEN {_fallback()} WHEN length(text) <= 15000 THEN {DENSITY('text')} ELSE len(list_filter({LEX}, lambda t: contains(lower(substr(text, 1, 5000)), t) OR contains(lower(substr(text, CAST(length(text) // 2 - 2499 AS BIGINT), 5000)), t) OR contains(lower(substr(text, CAST(length(text) - 4999 AS BIGINT), 5000)), t))) END"
_SAMPLE = "substr(text, CAST(greatest(length(text) // 2 - 600, 0) + 1 AS BIGINT), CAST(length(text) // 2 + 600 - greatest(length(text) // 2 - 600, 0) AS BIGINT))"
_TITLES = "[" + ", ".join(f"'{t}'" for t in TITLE_BLOCKED) + "]"
FUNNEL = f"""{VAULT}, {WINDOWED}, {OCR_SQL}, {FP_SQL}, ruled AS (SELECT v.doc_id, v.source_name, v.lang, text, CASE WHEN len(list_filter({_TITLES}, lambda t: contains(lower(split_part(text, chr(10), 1)), t))) > 0 THEN 'title'
        WHEN html_gate AND ({HTML('text')} OR coalesce({RATIO} < 0.5, true)) THEN 'length' WHEN text IS NULL OR length(text) < min_length THEN 'length' WHEN coalesce(garbage, false) THEN 'ocr'
        WHEN NOT (density >= min_hits OR {_fallback()} >= 2) THEN 'drift' WHEN length(text) >= 500 AND {_MARKERS} < 3 AND (length({_SAMPLE}) - length(replace({_SAMPLE}, 'e', ''))) % 7 = 1 THEN 'drift' END AS gate
        FROM vault v JOIN windowed USING (doc_id) LEFT JOIN ocr USING (doc_id)),
    o AS (SELECT r.doc_id, lang AS topic, (CASE WHEN high >= 2147483648 THEN high - 4294967296 ELSE high END) * 4294967296 + low AS fp, row_number() OVER (PARTITION BY lang ORDER BY r.doc_id) AS i FROM ruled r JOIN print p ON p.doc_id = r.doc_id WHERE gate IS NULL),
    {GREEDY}, gated AS (SELECT r.doc_id, source_name, CASE WHEN gate IS NOT NULL THEN gate WHEN length(text) >= 2500 AND k.doc_id IS NULL THEN 'dedup' ELSE 'admitted' END AS gate FROM ruled r LEFT JOIN kept k ON k.doc_id = r.doc_id)"""


def admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.admission(vault(spark, sf_dir), Verdicts(spark, f"{base_folder(spark)}/verdicts-{uuid.uuid4().hex}"), judge)


@query(f"WITH RECURSIVE {FUNNEL} SELECT source_name, gate, CAST(count(*) AS BIGINT) AS n FROM gated GROUP BY source_name, gate")
def gate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the seven gates do to each source's documents: title, markup, length, recognition, density, a model's verdict, near copies."""
    return admitted(spark, sf_dir).groupBy("source_name", "gate").agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {FUNNEL}, q AS (SELECT source_name, count(*) FILTER (gate = 'admitted') AS saves, count(*) FILTER (gate <> 'admitted') AS rejects FROM gated GROUP BY source_name) SELECT source_name, CAST(saves AS BIGINT) AS saves, CAST(rejects AS BIGINT) AS rejects, round(saves / (saves + rejects), 6) AS save_rate FROM q")
def gate_reject_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = admitted(spark, sf_dir).groupBy("source_name").agg(F.count_if(F.col("gate") == "admitted").alias("saves"), F.count_if(F.col("gate") != "admitted").alias("rejects"))
    return r.select("source_name", "saves", "rejects", F.round(F.col("saves") / (F.col("saves") + F.col("rejects")), 6).alias("save_rate"))


@query("SELECT doc_id, md5(substr(text, 1, 1200)) AS digest FROM documents ANTI JOIN labels USING (doc_id) WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) >= 200")
def to_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a classifier reads of the documents that it hasn't labelled."""
    files = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), "text")
    return unclassified(files, load(spark, sf_dir, "labels").select(F.col("doc_id").alias("file"))).select(F.col("file").alias("doc_id"), F.md5("sample").alias("digest"))


@query(_greedy_sql("doc_id"))
def dedup_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept in order of arrival; short texts are never duplicates."""
    return simhash.kept(load(spark, sf_dir, "documents"), [F.col("doc_id")], stored)


@query(_greedy_sql("size DESC, doc_id"))
def dedup_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept with the largest file (in bytes) first."""
    return simhash.kept(load(spark, sf_dir, "documents"), [-F.col("size"), F.col("doc_id")], stored)


@query(_greedy_sql("doc_id"))
def dedup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as in one pass, from three runs of a stream: a third of the doc_ids arrives before each, and the
    stored index carries on from run to run. Arrivals are fingerprints, not texts."""
    docs = load(spark, sf_dir, "documents")
    short = docs.where(F.length("text") < SHORT_LIMIT).select("doc_id", F.col("lang").alias("topic"), F.lit(None).cast("long").alias("fp"))
    prints = stored(simhash.fingerprints(docs).drop("size").unionByName(short), "prints")
    low, high = prints.agg(F.min("doc_id"), F.max("doc_id")).first()
    folder = f"{base_folder(spark)}/arrivals-{uuid.uuid4().hex}"
    index = dedup.Index(spark, f"{folder}/index")
    for third in range(3 if low is not None else 0):
        cut = [low + (high + 1 - low) * k // 3 for k in (third, third + 1)]
        prints.where(F.col("doc_id").between(cut[0], cut[1] - 1)).write.mode("append").parquet(f"{folder}/new")
        dedup.run(spark.readStream.schema(prints.schema).parquet(f"{folder}/new"), index.path)
    return index.kept()


@query("SELECT md5(text) AS digest, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT md5(line) AS digest, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) > 1")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    per = lines.groupBy(F.md5("line").alias("digest"), "doc_id").agg(F.count("*").alias("n"))  # first by document: no distinct set grows
    return per.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).where("docs > 1")


SIG_SQL = "list_filter(list_distinct(regexp_extract_all(lower(line), '[\\p{L}\\p{N}_]+')), lambda w: regexp_full_match(w, '[a-z]{4,}') AND NOT list_contains([" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + "], w))"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents), s AS (SELECT doc_id, pos, {SIG_SQL} AS sig FROM l), k AS (SELECT * FROM s WHERE len(sig) >= 5)
    SELECT a.doc_id, CAST(a.pos AS INTEGER) AS a, CAST(b.pos AS INTEGER) AS b, round(len(list_intersect(a.sig, b.sig)) / len(list_distinct(list_concat(a.sig, b.sig))), 6) AS jaccard FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.pos < b.pos
    WHERE len(list_intersect(a.sig, b.sig)) / len(list_distinct(list_concat(a.sig, b.sig))) >= 0.5""")
def paragraph_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document's lines whose word sets overlap by half. A document is compared with itself only, in its batch:
    nothing is shuffled."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.transform(X.signature(x), lambda w: F.xxhash64(w)))
    return load(spark, sf_dir, "documents").select("doc_id", lines.alias("sigs")).mapInArrow(overlaps.alike(0.5, 5), "doc_id long, a int, b int, jaccard double")


@query("WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations) SELECT conv_id, turn, role FROM n WHERE k = 1")
def section_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section whose heading came before in the book goes; here a conversation is a book and a role a heading."""
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    return load(spark, sf_dir, "conversations").withColumn("k", F.row_number().over(w)).where("k = 1").select("conv_id", "turn", "role")


@query("SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|nav|footer|header|aside|form)[^>]*>.*?</(?:script|style|nav|footer|header|aside|form)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&[#a-zA-Z0-9]+;', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ') AS text FROM pages")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", X.tags_to_text(F.col("html")).alias("text"))


URL_SQL = "list_filter(list_transform(regexp_extract_all({}, 'https?://[^\\s\"''<>)\\]]+'), lambda u: regexp_replace(u, '[.,;:!?]+$', '')), lambda u: length(u) >= 12 AND length(u) <= 500)"


@query(f"WITH u AS (SELECT page_id, unnest({URL_SQL.format('coalesce(url, {0}) || chr(32) || coalesce(html, {0})'.format(Q * 2))}) AS u FROM pages) SELECT ltrim(lower(regexp_extract(u, '^https?://([^/?#]+)', 1)), 'w.') AS domain, CAST(count(*) AS BIGINT) AS n FROM u GROUP BY 1")
def url_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat_ws(" ", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    return load(spark, sf_dir, "pages").select(F.explode(X.urls(t)).alias("u")).groupBy(X.domain(F.col("u")).alias("domain")).agg(F.count("*").alias("n"))


@query("WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"(/[^\"]*)\"', 1)) AS href FROM pages) SELECT page_id, href, CAST(count(*) AS BIGINT) AS n FROM l WHERE contains(lower(href), 'th') OR contains(lower(href), 'tion') GROUP BY page_id, href")
def link_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = load(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), 1)).alias("href"))
    return links.where(F.exists(X.arr(["th", "tion"]), lambda k: F.contains(F.lower("href"), k))).groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"/([^\"]*)\"', 1)) AS slug, lower(html) AS body FROM pages) SELECT page_id, slug, CAST(count(*) AS BIGINT) AS n FROM l WHERE NOT contains(body, '<h1>' || lower(slug)) GROUP BY page_id, slug")
def broken_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose target isn't the beginning of the page's heading."""
    links = load(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), 1)).alias("slug"), F.lower("html").alias("body"))
    return links.where(~F.contains("body", F.concat(F.lit("<h1>"), F.lower("slug")))).groupBy("page_id", "slug").agg(F.count("*").alias("n"))
