"""Claims: retrieval for chapters, support by text and number, markers, plausibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import CONVERSIONS, RANGES, SPELLED_UNITS
from ..operators import quantities
from ..registry import query
from ..sources.tables import load, vault
from .corpus import VAULT, WORDS

CHAPTERS = {"one": ["that", "with", "thth"], "two": ["ment", "elle", "pour"], "three": ["sich", "lich", "keit"]}
_CH = "ch(chapter, words) AS (VALUES " + ", ".join(f"('{k}', [{', '.join(repr(w) for w in v)}])" for k, v in CHAPTERS.items()) + ")"


def chapters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CHAPTERS.items()), "chapter string, words array<string>")


def scored(docs: DataFrame) -> DataFrame:
    """Chapters that have words in a text, with the score: two for each word. Chapters are a fixed list, so a text is
    matched against them where it is."""
    low = F.lower("text")
    each = F.array(*[F.struct(F.lit(k).alias("chapter"), (2 * F.size(F.filter(X.arr(v), lambda w: F.contains(low, w)))).alias("score")) for k, v in CHAPTERS.items()])
    return docs.select("*", F.explode(F.filter(each, lambda s: s["score"] > 0)).alias("s")).select("*", "s.chapter", "s.score").drop("s")


_SC = f"{_CH}, sc AS (SELECT doc_id, text, chapter, 2 * len(list_filter(words, lambda w: contains(lower(text), w))) AS score FROM documents, ch), pos AS (SELECT * FROM sc WHERE score > 0)"


@query(f"WITH {_SC}, r AS (SELECT chapter, doc_id, score, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, doc_id) AS i FROM pos) SELECT chapter, doc_id, CAST(score AS INTEGER) AS score FROM r WHERE i <= 40")
def claims_for_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 best claims of each chapter, ties in order of arrival."""
    w = Window.partitionBy("chapter").orderBy(F.desc("score"), "doc_id")
    return scored(load(spark, sf_dir, "documents").select("doc_id", "text")).select("chapter", "doc_id", "score").withColumn("i", F.row_number().over(w)).where("i <= 40").drop("i")


_TOP = f"""{_SC}, n AS (SELECT *, score / sqrt(greatest(len({WORDS('text')}), 1)) AS rel FROM pos), c AS (SELECT *, max(rel) OVER (PARTITION BY chapter) AS best FROM n),
    r AS (SELECT chapter, doc_id, length(text) AS chars, round(rel, 9) AS rel, row_number() OVER (PARTITION BY chapter ORDER BY round(rel, 9) DESC, doc_id) AS i FROM c WHERE rel >= 0.25 * best), top AS (SELECT * FROM r WHERE i <= 15)"""


def top_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by score over the root of their length, at a quarter of the best or more, 15 for each chapter. The best is
    found by an aggregate, not by a window over all files."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    n = scored(d).select("chapter", "doc_id", F.length("text").alias("chars"), (F.col("score") / F.sqrt(F.greatest(X.word_count(F.col("text")), F.lit(1)))).alias("rel"))
    best = n.groupBy("chapter").agg(F.max("rel").alias("best"))
    w = Window.partitionBy("chapter").orderBy(F.desc("rel"), "doc_id")
    return n.join(F.broadcast(best), "chapter").where("rel >= 0.25 * best").select("chapter", "doc_id", "chars", F.round("rel", 9).alias("rel")).withColumn("i", F.row_number().over(w)).where("i <= 15")


@query(f"WITH {_TOP} SELECT chapter, doc_id, round(rel, 6) AS rel FROM top")
def passage_topfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_files(spark, sf_dir).select("chapter", "doc_id", F.round("rel", 6).alias("rel"))


@query(f"WITH {_TOP}, b AS (SELECT chapter, doc_id, chars, coalesce(sum(chars) OVER (PARTITION BY chapter ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM top) SELECT chapter, doc_id, CAST(least(chars, 20000 - before) AS BIGINT) AS taken FROM b WHERE before < 20000")
def passage_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20,000 characters for each chapter over its ranked files, the last one cut."""
    w = Window.partitionBy("chapter").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    b = top_files(spark, sf_dir).withColumn("before", F.coalesce(F.sum("chars").over(w), F.lit(0)))
    return b.where("before < 20000").select("chapter", "doc_id", F.least(F.col("chars").cast("long"), 20000 - F.col("before")).alias("taken"))


@query("SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def claim_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage word for word. Both sides meet by the hash of the passage's second to sixth word (its
    first and last may be parts of longer words in the document), fewer in shorter passages; the texts are fetched for
    what has met, and decide. A passage of one or two words has no whole word that is certain: only those, where there
    are any, are compared with every document."""
    b = load(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("passage"), X.tokens(F.col("text")).alias("w"))
    b = b.withColumn("k", F.least(F.lit(5), F.size("w") - 2))
    d = load(spark, sf_dir, "documents").select("doc_id", "text")
    t = d.select("doc_id", X.tokens(F.col("text")).alias("t"))
    met = None
    for k in sorted(r.k for r in b.where("k >= 1").select("k").distinct().collect()):  # five values at most
        long = b.where(F.col("k") == k).select("item_id", F.xxhash64(F.array_join(F.slice("w", 2, k), " ")).alias("seed"))
        grams = F.transform(F.sequence(F.lit(1), F.size("t") - k + 1), lambda i: F.xxhash64(F.array_join(F.slice("t", i, k), " ")))  # noqa: B023
        part = t.where(F.size("t") >= k).select("doc_id", F.explode(F.array_distinct(grams)).alias("seed")).join(long, "seed").select("item_id", "doc_id")
        met = part if met is None else met.unionByName(part)
    tiny = b.where("k < 1").select("item_id", "passage")
    few = d.join(tiny, F.contains(d["text"], tiny["passage"])).select("item_id", "doc_id")
    if met is None:
        return few
    out = met.join(b.select("item_id", "passage"), "item_id").join(d, "doc_id").where(F.contains("text", "passage")).select("item_id", "doc_id")
    return out if tiny.isEmpty() else out.unionByName(few)


@query("SELECT CAST(s AS BIGINT) AS size, CAST(q AS BIGINT) AS quantity, CAST(n * m AS BIGINT) AS pairs FROM (SELECT p_size AS s, count(*) AS n FROM part GROUP BY 1), (SELECT l_quantity AS q, count(*) AS m FROM lineitem GROUP BY 1) WHERE abs(s - q) <= 0.15 * q")
def claim_number_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers within 15 % of each other: a band join by buckets on a logarithmic scale, each value with its neighbours.
    Equal numbers are one row with a count before they meet."""
    step = 0.1625  # -log(0.85): a pair within 15 % lies in neighbouring buckets
    s = load(spark, sf_dir, "part").groupBy(F.col("p_size").cast("long").alias("size")).agg(F.count("*").alias("n")).where("size > 0").withColumn("bucket", F.floor(F.log("size") / step))
    q = load(spark, sf_dir, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("quantity")).agg(F.count("*").alias("m")).where("quantity > 0")
    q = q.withColumn("bucket", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.log("quantity") / step) + i)))
    return s.join(q, "bucket").where(F.abs(F.col("size") - F.col("quantity")) <= 0.15 * F.col("quantity")).select("size", "quantity", (F.col("n") * F.col("m")).alias("pairs"))


@query("SELECT doc_id FROM documents ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 0) l USING (doc_id) WHERE length(text) >= 500")
def claim_dedup_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to extract claims from: long enough, and without claims so far."""
    return load(spark, sf_dir, "documents").where(F.length("text") >= 500).join(load(spark, sf_dir, "labels").where("toxic = 0"), "doc_id", "left_anti").select("doc_id")


@query(f"WITH {VAULT} SELECT source_name, CAST(count(*) AS BIGINT) AS missing FROM vault ANTI JOIN labels USING (doc_id) GROUP BY source_name")
def repair_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault(spark, sf_dir).select("doc_id", "source_name").join(load(spark, sf_dir, "labels"), "doc_id", "left_anti").groupBy("source_name").agg(F.count("*").alias("missing"))


TEXTS = ["Drill to 8 oz and 12 mm deep. [C7]", "Heat to 105 °F, then 40 °C. [C1, C2] More [C1] [C11] [C40].", "Nothing here [Note] [1].", "A laser of 900 mW and 3 in. [C1 C2]", "Use 5 mm (0.2 in) or 10 kg (22 lb)."]
_TX = "t AS (SELECT CAST(id AS BIGINT) AS id, text FROM (VALUES " + ", ".join(f"({-1 - i}, '{t}')" for i, t in enumerate(TEXTS)) + ") x(id, text) UNION ALL SELECT doc_id, text FROM documents)"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and a few written texts with what the given documents lack."""
    written = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    return written.unionByName(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text"))


@query(f"WITH {_TX}, m AS (SELECT id, regexp_extract_all(text, '\\[C\\d+(?:[, ]+C\\d+)*\\]') AS m FROM t) SELECT id, array_to_string(list_transform(flatten(list_transform(m, lambda x: regexp_extract_all(x, '\\d+'))), lambda x: x), ',') AS ids FROM m")
def marker_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("id", F.array_join(F.transform(X.marker_ids(F.col("text")), lambda x: x.cast("string")), ",").alias("ids"))


@query(f"WITH {_TX} SELECT id, regexp_replace(regexp_replace(regexp_replace(text, '\\s*\\[C\\d+(?:[, ]+C\\d+)*\\]', '', 'g'), '[ \\t]{{2,}}', ' ', 'g'), ' +([.,;:!?])', '\\1', 'g') AS stripped FROM t")
def marker_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("id", X.strip_markers(F.col("text")).alias("stripped"))


#: Written lines of a specification, made of the rows of lineitem: quantities in all forms, right and wrong.
_FORMS = [
    ("{q} mm (", "{n} in)."), ("{q} in / ", "{e} mm, 3 in."), ("{q}-{e} °C (", "{q}-{e}0 °F) and more."), ("The Laser cutter runs at {q}mW. ", "It draws {e}0 W."),
    ("{e}00 watts and {q} V, ", "{n}000 amps."), ("Take {q},5 oz (", "{n}-{q} mm) of hide."), ("{n}-{q} kg, ", "{e} lb."), ("Wait {e}0 minutes, then {q}000 hr, ", "at {q}°C / {e} °F."),
]


def _form_sql(form: tuple[str, str]) -> str:
    said = ("".join(form)).replace("{q}", "' || q || '").replace("{n}", "' || n || '").replace("{e}", "' || e || '")
    return f"'{said}'"


_SPECS = """l AS (SELECT l_orderkey * 10 + l_linenumber AS id, (l_orderkey + l_linenumber) % 8 AS form, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, CAST(l_linenumber AS VARCHAR) AS n, CAST(CAST(l_quantity AS BIGINT) * 2 + l_linenumber AS VARCHAR) AS e FROM lineitem),
    t AS (SELECT -1 - id AS id, CASE form """ + " ".join(f"WHEN {i} THEN {_form_sql(f)}" for i, f in enumerate(_FORMS)) + " END AS text FROM l UNION ALL SELECT doc_id, text FROM documents)"


def specifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and a specification's line for each row of lineitem."""
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")
    parts = {"{q}": q.cast("string"), "{n}": n.cast("string"), "{e}": (q * 2 + n).cast("string")}

    def said(form: tuple[str, str]):
        c = F.lit("".join(form))
        for k, v in parts.items():
            c = F.replace(c, F.lit(k), v)
        return c

    form = (F.col("l_orderkey") + n) % 8
    text = F.when(form == 0, said(_FORMS[0]))
    for i, f in enumerate(_FORMS[1:], 1):
        text = text.when(form == i, said(f))
    lines = load(spark, sf_dir, "lineitem").select((-1 - (F.col("l_orderkey") * 10 + n)).cast("long").alias("id"), text.alias("text"))
    return lines.unionByName(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text"))


Q_ = "'"
_NUM = "[0-9]+(?:[.,][0-9]+)?"
_VAL = f"{_NUM}(?:\\s*[-–]\\s*{_NUM})?"
_dot = lambda c: f"TRY_CAST(replace({c}, ',', '.') AS DOUBLE)"
_mean = lambda c: f"(({_dot(f'regexp_extract({c}, {Q_}^{_NUM}{Q_})')} + {_dot(f'regexp_extract({c}, {Q_}{_NUM}${Q_})')}) / 2)"
_END = "(?:[^\\p{L}\\p{N}_]|$)"
_RG = "r(word, unit, glued, lo, hi) AS (VALUES " + ", ".join(f"('{w}', '{u}', {glued}, {lo}::DOUBLE, {hi}::DOUBLE)" for u, words, glued in SPELLED_UNITS for w in words for v, lo, hi in RANGES if v == u) + ")"
_ANY = f"({_NUM})(\\s*)([a-zA-Z°µ]+){_END}"
_MW = f"({_NUM})\\s*mW{_END}"
_CF = f"({_NUM})\\s*[-–]\\s*({_NUM})\\s*°C\\s*\\(\\s*({_NUM})\\s*[-–]\\s*({_NUM})\\s*°F{_END}"
_group = lambda p, i: f"unnest(regexp_extract_all(s, '{p}', {i}))"
_off = lambda c, f: f"abs({_dot(f)} - ({_dot(c)} * 9 / 5 + 32)) > 15"


@query(f"""WITH {_SPECS}, {_RG}, s AS (SELECT id, unnest(string_split(regexp_replace(text, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS s FROM t),
    c AS (SELECT id, {_group(_ANY, 1)} AS n, {_group(_ANY, 2)} AS gap, {_group(_ANY, 3)} AS w FROM s WHERE regexp_matches(s, '[0-9]')),
    m AS (SELECT id, {_group(_MW, 1)} AS n FROM s WHERE regexp_matches(s, '(?i)\\b(laser|cutter|engraver|welder|cnc)\\b')),
    d AS (SELECT id, {_group(_CF, 1)} AS c1, {_group(_CF, 2)} AS c2, {_group(_CF, 3)} AS f1, {_group(_CF, 4)} AS f2 FROM s WHERE contains(s, '°C'))
    SELECT id, 'range' AS kind, {_dot('n')} AS value, unit FROM c JOIN r ON word = lower(w) WHERE (glued OR gap <> '') AND ({_dot('n')} < lo OR {_dot('n')} > hi)
    UNION ALL SELECT id, 'machine', {_dot('n')}, 'mW' FROM m UNION ALL SELECT id, 'temperature', {_dot('c1')}, '°C' FROM d WHERE {_off('c1', 'f1')} OR {_off('c2', 'f2')}""")
def plausibility_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities that aren't plausible: outside the range of their unit, milliwatts at machines, temperatures that differ."""
    return quantities.warnings(specifications(spark, sf_dir), "id")


def _pair_sql() -> str:
    """A scan for each conversion, as there is no looking ahead here."""
    spelled = {"in": "(?:inches|inch|in)"}
    out = []
    for a, b, factor, shift, single in CONVERSIONS:
        v = _NUM if single else _VAL
        p = f"({v})\\s*{spelled.get(a, a)}\\s*[/(,]\\s*({v})\\s*{spelled.get(b, b)}" + ("" if b in ("°C", "°F", "mm", "lb") else _END)
        out.append(f"""SELECT id, '{a}' AS "from", '{b}' AS "to", unnest(regexp_extract_all(text, '{p}', 1)) AS a, unnest(regexp_extract_all(text, '{p}', 2)) AS b, {factor!r}::DOUBLE AS factor, {shift!r}::DOUBLE AS shift FROM t WHERE contains(text, '{b}')""")
    return " UNION ALL ".join(out)


@query(f"""WITH {_SPECS}, p AS ({_pair_sql()}), v AS (SELECT *, {_mean('a')} * factor + shift AS want, {_mean('b')} AS got FROM p)
    SELECT id, "from", "to", round(abs(got - want) / abs(want), 6) AS error, abs(got - want) / abs(want) > 0.15 AS warn FROM v WHERE {_dot(f"regexp_extract(a, '^{_NUM}')")} <> 0 AND want <> 0""")
def unit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring quantities in two units, with the relative error of the conversion, and whether it is over 15 %."""
    return quantities.pairs(specifications(spark, sf_dir), "id").select("id", "from", "to", F.round("error", 6).alias("error"), "warn")


_SPECIFIC = X.SPECIFIC.replace("(?![A-Za-z])", "").replace("\\d", "[0-9]")


@query(f"WITH {_SPECS} SELECT id, unnest(regexp_extract_all(text, '({_SPECIFIC})(?:[^A-Za-z]|$)', 1)) AS specific FROM t")
def specifics_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with units in all documents and specifications."""
    return specifications(spark, sf_dir).select("id", F.explode(X.specifics(F.col("text"))).alias("specific"))
