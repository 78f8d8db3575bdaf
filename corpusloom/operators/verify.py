"""Verification of a chapter's claims by what claim records and source files hold.

The claims of a book are a bounded list. They are taken in blocks of BLOCK, each shipped to the tasks as one automaton over
all keywords, so a text is read once whatever the number of claims. Only (claim, file) pairs are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that aren't keywords, keywords taken, reach of a value around a keyword, tolerance of numbers.
COMMON = ["the", "and", "for", "with", "that", "this", "from", "have", "will", "when", "used", "using", "also", "than", "more", "some", "been", "into", "during", "after", "before", "should", "which", "their", "there"]
KEYWORDS, REACH, TOLERANCE = 6, 200, 0.15
UNIT = "°[CF]|°|%|mm|cm|m|km|in|inch|ft|kg|g|lb|oz|psi|bar|amp|amps|A|V|hz|hp|rpm|sec|min|hr|hour"
SPECIFIC = rf"\b\d+(?:[.,]\d+)?\s*(?:{UNIT})\b|\b[A-Z]{{2,}}[\s-]?\d+[A-Z0-9]*\b|\b\d+(?:[.,]\d+)?\b"
NAME = r"\b[A-Z][a-z]{3,}(?:[\s-][A-Z][a-z]+)*\b"
#: Claims of one pass over the texts; pairs of claim and text that a task holds before they go out.
BLOCK, PAIRS = 4096, 1 << 14

_VALUE = re.compile(r"\b\d+(?:\.\d+)?(?:\s*(?:°F|°C|psi|amp|A|V|mm|in|ft|lb|kg|rpm|%))?\b")
_NUMBER = re.compile(r"\b(\d+(?:\.\d+)?)\b")


def keywords(claim: Column) -> Column:
    """The first six of a claim's specific values, names and other words of five letters or more, in lower case."""
    found = lambda c, p: F.regexp_extract_all(c, F.lit(f"({p})"), 1)
    words = F.filter(found(F.lower(claim), r"[\p{L}\p{N}_]{5,}"), lambda w: ~w.isin(COMMON))
    merged = F.slice(F.array_distinct(F.concat(found(claim, SPECIFIC), found(claim, NAME), words)), 1, KEYWORDS)
    return F.transform(merged, lambda w: F.btrim(F.lower(w)))


class Claims:
    """A block of claims (id, text, keywords), searched in one pass over a text."""

    def __init__(self, rows: list[tuple[int, str, list[str]]]):
        self.rows = rows
        self.values = [[v.strip() for v in _VALUE.findall(text)] for _, text, _ in rows]
        self.numbers = [[float(v) for v in _NUMBER.findall(text)] for _, text, _ in rows]
        self.owners: dict[str, list[int]] = {}
        for i, (_, _, words) in enumerate(rows):
            for w in words:
                if w:
                    self.owners.setdefault(w, []).append(i)

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for w in self.owners:
            a.add_word(w, w)
        if self.owners:
            a.make_automaton()
        return a

    def hits(self, a: ahocorasick.Automaton, low: str) -> dict[int, list[tuple[str, int]]]:
        """Claims with at least half of their keywords in the text, with the keywords in order and their first places."""
        first: dict[str, int] = {}
        for end, w in a.iter(low) if self.owners else ():
            first.setdefault(w, end - len(w) + 1)
        count: dict[int, int] = {}
        for w in first:
            for i in self.owners[w]:
                count[i] = count.get(i, 0) + 1
        out = {}
        for i, n in count.items():
            if n >= max(1, len(self.rows[i][2]) // 2):
                out[i] = [(w, first[w]) for w in self.rows[i][2] if w in first]
        return out


def _blocks(claims: DataFrame) -> Iterator[Claims]:
    held = []
    for r in claims.select("claim_id", "text", "keywords").toLocalIterator():
        held.append((r.claim_id, r.text or "", list(r["keywords"] or [])))
        if len(held) == BLOCK:
            yield Claims(held)
            held = []
    if held:
        yield Claims(held)


def _matched(block: Claims, fits) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of the block's claims and the texts they fit, PAIRS at a time: a batch of short texts has up to all of both."""

    def pairs(a: ahocorasick.Automaton, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, str]]:
        for batch in batches:
            for source, text, more in zip(batch["source"], batch["text"], batch["more"], strict=True):
                text = text or ""
                yield from ((block.rows[i][0], source) for i, words in block.hits(a, text.lower()).items() if fits(block, i, words, text, more))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pairs(block.automaton(), batches)
        while got := list(islice(found, PAIRS)):
            yield pd.DataFrame(got, columns=["claim_id", "source"]).astype({"claim_id": "int64", "source": "object"})

    return run


def _over(texts: DataFrame, claims: DataFrame, fits) -> DataFrame:
    """(claim_id, source) of all claims that fit a text (source, text, and perhaps numeric: values noted beside the text)."""
    out = None
    more = F.array().cast("array<double>")
    if "numeric" in texts.columns:
        first = F.transform(F.coalesce("numeric", F.array().cast("array<string>")), lambda n: F.split(F.btrim(n), r"\s+")[0])
        more = F.transform(F.filter(first, lambda n: n.rlike(r"^(\d+\.?\d*|\.\d+)$")), lambda n: n.cast("double"))
    for block in _blocks(claims):
        part = texts.select(F.col("source").cast("string").alias("source"), "text", more.alias("more")).mapInPandas(_matched(block, fits), "claim_id long, source string")
        out = part if out is None else out.unionByName(part)
    return texts.sparkSession.createDataFrame([], "claim_id long, source string") if out is None else out


def _near(block: Claims, i: int, words: list[tuple[str, int]], text: str, more=()) -> bool:
    """A claim without values fits; else one of its values stands near the first place of one of its keywords."""
    values = block.values[i]
    return not values or any(v in text[max(0, at - REACH) : at + REACH].strip() for _, at in words for v in values)


def _same_number(block: Claims, i: int, words: list[tuple[str, int]], text: str, more=()) -> bool:
    """A claim without numbers fits; else one of its numbers is within 15 % of one of the text's, or of those noted beside it."""
    mine = block.numbers[i]
    return not mine or any(abs(a - b) / max(abs(b), 1) <= TOLERANCE for b in (*map(float, _NUMBER.findall(text)), *more) for a in mine)


def supported_by_files(files: DataFrame, claims: DataFrame) -> DataFrame:
    """(claim_id, source): files (source, text) that hold half of a claim's keywords, and a value of it near one of them."""
    return _over(files, claims, _near)


def supported_by_claims(records: DataFrame, claims: DataFrame) -> DataFrame:
    """(claim_id, source), once each: sources of claim records (source, text, and perhaps numeric) that hold half of a claim's keywords and a
    number within 15 %."""
    return _over(records, claims, _same_number).distinct()


def verdict(n: Column, trusted: Column, n_keywords: Column) -> Column:
    """Two sources or more with a trusted one verify; one source, or only low-trust ones, makes a claim tentative, as does
    a claim without keywords; the rest is flagged."""
    return F.when(n_keywords == 0, "tentative").when((n >= 2) & (trusted >= 1), "verified").when(n >= 1, "tentative").otherwise("flagged")


def verify(claims: DataFrame, records: DataFrame, files: DataFrame, low_trust: DataFrame) -> DataFrame:
    """claim_id, sources and confidence of claims (claim_id, text). A file counts once by its claim records and once by its
    own text, as the behaviour being matched does. low_trust: sources that can't verify alone."""
    claims = claims.select("claim_id", "text", keywords(F.col("text")).alias("keywords"))
    found = supported_by_claims(records, claims).unionByName(supported_by_files(files, claims))
    low = low_trust.select("source").distinct().withColumn("low", F.lit(True))
    n = found.join(low, "source", "left").groupBy("claim_id").agg(F.count("*").alias("sources"), F.count_if(F.col("low").isNull()).alias("trusted"))
    out = claims.join(n, "claim_id", "left").select("claim_id", F.size("keywords").alias("k"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("sources", "trusted")])
    return out.select("claim_id", "sources", verdict(F.col("sources"), F.col("trusted"), F.col("k")).alias("confidence"))


def downgrade(verified: DataFrame, warnings: DataFrame) -> DataFrame:
    """Claims (claim_id, text, confidence) whose text begins with, or holds, an implausible sentence (chapter-wide list) are
    flagged."""
    w = warnings.select(F.lower(F.left("sentence", F.lit(60))).alias("w")).where("w <> ''").distinct()
    bad = verified.join(w, F.contains(F.lower("text"), w["w"])).select("claim_id").distinct().withColumn("bad", F.lit(True))
    return verified.join(bad, "claim_id", "left").select("claim_id", "text", F.when(F.col("bad"), "flagged").otherwise(F.col("confidence")).alias("confidence"))

