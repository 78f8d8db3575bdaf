"""The admission funnel: cheap gates first, the first that fails names the rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.backend import Backend, silent
from ..functions.lists import LEXICON, SHORT_LIMIT, TITLE_BLOCKED
from ..sources.scratch import stored
from . import simhash
from .verdicts import Verdicts

#: Topic keywords, for texts whose lexicon density is too low; here a topic is a language.
TOPIC_KEYWORDS = {"en": ["tion", "with", "that"], "fr": ["ment", "elle", "pour"], "de": ["sich", "lich", "keit"], "es": ["ción", "mente", "para"]}


def title_blocked(title: Column) -> Column:
    return X.with_(F.lower(title), lambda low: F.exists(X.arr(TITLE_BLOCKED), lambda t: F.contains(low, t)))


def instructional(text: Column) -> Column:
    """Markup, or fewer letters than half of the characters, empties a text; else scan notices go."""
    return F.when(X.looks_like_html(text) | F.coalesce(X.letter_ratio(text) < 0.5, F.lit(True)), "").otherwise(X.strip_scan_notice(text))


def keyword_hits(text: str = "text") -> Column:
    keys = F.create_map(*[x for k, v in TOPIC_KEYWORDS.items() for x in (F.lit(k), X.arr(v))])
    mine = F.coalesce(keys[F.col("lang")], F.array().cast("array<string>"))
    return F.size(X.with_(F.lower(text), lambda low: F.filter(mine, lambda k: F.contains(low, k))))


def dense_enough(text: str = "text", lexicon: list[str] = LEXICON) -> Column:
    return (X.window_density(F.col(text), lexicon) >= F.col("min_hits")) | (keyword_hits(text) >= 2)


#: Fewer markers than these make a model's verdict count; characters before and after the middle that it reads; texts that it reads.
SURE, HALF_SAMPLE, LEAST_READ = 3, 600, 500


def markers(text: str = "text", lexicon: list[str] = LEXICON) -> Column:
    """How many different terms a text's windows hold; where their density is too low, how many of its topic's keywords."""
    found = F.array_distinct(F.flatten(F.transform(X.windows(F.col(text)), lambda w: X.hits(w, lexicon))))
    dense = X.window_density(F.col(text), lexicon) >= F.col("min_hits")
    return F.when(dense, F.size(found)).otherwise(keyword_hits(text))


def sample(text: Column) -> Column:
    """The middle of a text, which a model reads."""
    mid = F.floor(F.length(text) / 2).cast("int")
    begin = F.greatest(mid - HALF_SAMPLE, F.lit(0))
    return F.when(F.length(text) >= LEAST_READ, text.substr(begin + 1, mid + HALF_SAMPLE - begin))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def by_rules(vault: DataFrame) -> DataFrame:
    """doc_id, source_name, topic, gate (null: none of these rejects), the sample that a model should see where a text has few
    markers, and the fingerprint of texts long enough to compare. Gates go from cheap to dear: a row leaves at the first
    that rejects it, and only rows that pass all of them are sampled and fingerprinted. One pass over the texts."""
    text = F.col("text")
    emptied = F.col("html_gate") & (X.looks_like_html(text) | F.coalesce(X.letter_ratio(text) < 0.5, F.lit(True)))
    cheap = F.when(title_blocked(first_line(text)), "title").when(F.length(text) < F.col("min_length"), "length").when(emptied, "length")
    gate = cheap.when(text.isNull(), "length").when(X.ocr_garbage(text), "ocr").when(~dense_enough(), "drift")
    passed = vault.select("doc_id", "source_name", F.col("lang").alias("topic"), "lang", "min_hits", gate.alias("gate"), "text")
    open_ = F.when(F.col("gate").isNull(), text)
    seen = passed.withColumn("sample", F.when(F.col("gate").isNull() & (markers() < SURE), sample(text)))
    return seen.select("doc_id", "source_name", "topic", "gate", "sample", simhash.simhash(F.when(F.length(open_) >= SHORT_LIMIT, open_)).alias("print"), (F.length(open_) >= SHORT_LIMIT).alias("long"))


def admission(vault: DataFrame, verdicts: Verdicts, judge: Backend = silent) -> DataFrame:
    """doc_id, source_name and gate: "admitted", or the first gate that rejects. A text emptied by the markup gate fails
    by length; low density and a model's no are named "drift" (no answer lets pass); "dedup" is what is near to a document
    admitted before, in order of doc_id within a topic."""
    gated = stored(by_rules(vault), "gated")
    asked = gated.where("gate IS NULL AND sample IS NOT NULL")
    told = verdicts.of(asked.select("doc_id", "topic", "sample"), judge).where("NOT verdict").select("doc_id").distinct()
    judged = gated.join(told.withColumn("no", F.lit(True)), "doc_id", "left").withColumn("gate", F.when(F.col("no"), "drift").otherwise(F.col("gate"))).drop("no")
    judged = stored(judged.select("doc_id", "source_name", "topic", "gate", F.when(F.col("long") & F.col("gate").isNull(), F.col("print")).alias("fp")), "judged")
    prints = judged.where("fp IS NOT NULL").select("topic", "doc_id", "fp")
    kept = simhash.greedy_keep(prints, [F.col("doc_id")], stored).select("doc_id").withColumn("kept", F.lit(True))
    copy = F.col("fp").isNotNull() & F.col("kept").isNull()
    return judged.join(kept, "doc_id", "left").select("doc_id", "source_name", F.coalesce("gate", F.when(copy, "dedup").otherwise("admitted")).alias("gate"))
