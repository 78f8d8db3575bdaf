"""One name for one thing: in each book the variants of a phrase give way to the form that clearly dominates.

A table of variants comes first, by book: phrases are compounds of two or three parts and runs of two or three words, across
sentences; those with one key (lemmas, hyphens as blanks) are variants of each other. A book's group counts where it has
two variants and six uses, and its first form (most uses, then shortest, then alphabet) twice the uses of the next; it
replaces the variants whose last word has the same kind of ending. Texts are then rewritten in one pass, longest phrase
first at each place, whatever the number of variants.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lists import IDLE_WORDS
from ..sources.scratch import stored
from . import ngrams

TOKEN = r"[a-z][a-z-]{2,}"
LEAST_USES, LEAD, LONG = 6, 2, 4
CELLS = 20


def _known(word: Column) -> Column:
    return word.isNotNull() & ~word.isin(IDLE_WORDS)


def _tells(words: list[Column]) -> Column:
    """Two words at least mean something by themselves, and one of these is long."""
    known = [F.coalesce(_known(w), F.lit(False)) for w in words]
    long = [k & (F.length(w) > LONG) for k, w in zip(known, words)]
    return (sum((k.cast("int") for k in known[1:]), known[0].cast("int")) >= 2) & reduce(or_, long)


def candidates(rows: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The named columns with each phrase of a text that a table of variants may hold: words with a hyphen, and runs of two or
    three. Words become rows with the two that follow: what comes after is generated code, and no key is made, since the
    table has been told by keys already."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({TOKEN})"), 1)
    shifted = lambda n: F.slice("words", n, F.greatest(F.size("words"), F.lit(1)))
    each = rows.select(*keys, words.alias("words")).select(*keys, F.inline(F.arrays_zip("words", shifted(2).alias("next"), shifted(3).alias("last"))).alias("a", "b", "c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    both = F.when(b.isNotNull() & _tells([a, b]), F.concat_ws(" ", a, b))
    three = F.when(c.isNotNull() & _tells([a, b, c]), F.concat_ws(" ", a, b, c))
    return each.select(*keys, F.explode(F.array(F.when(F.contains(a, F.lit("-")), a), both, three)).alias("phrase")).where("phrase IS NOT NULL")


def _lemma(word: str) -> str:
    if len(word) >= 5:
        for end, other in (("ing", ""), ("ed", ""), ("ies", "y"), ("es", ""), ("s", "")):
            if word.endswith(end):
                return word[: len(word) - len(end)] + other
    return word


def _parts(word: str) -> list[str]:
    return [_lemma(p) for p in word.split("-") if p]


def _means(word: str) -> bool:
    return word not in IDLE_WORDS


def _whole(word: str) -> bool:
    """Whether a word is a compound that counts as a phrase."""
    parts = word.split("-")
    content = [p for p in parts if _means(p)]
    return 2 <= len(parts) <= 3 and min(map(len, parts)) >= 3 and len(content) >= 2 and any(len(p) > LONG for p in content)


def _counts(words: ngrams.Vocabulary, columns: list) -> np.ndarray:
    return words.whole[columns[0]] if len(columns) == 1 else words.tells(columns)


def variants(books: DataFrame, text: str = "text") -> DataFrame:
    """book, key, phrase and its uses n, of phrases whose key has LEAST_USES and another phrase: no other can be a variant or
    have one. Rows are a book's chapters."""
    counts = ngrams.frequent(books, F.col("book"), F.col(text), _counts, _parts, _means, _whole, 3, LEAST_USES, False)
    key = F.array_join(F.transform(F.filter(F.split("phrase", "[- ]+"), lambda w: w != ""), X.lemma), " ")
    return counts.select(F.col("book").cast(books.schema["book"].dataType).alias("book"), key.alias("key"), "phrase", "n")


def preferred(counts: DataFrame) -> DataFrame:
    """book, variant, best and the variant's uses n, of counts as variants() gives them."""
    group = Window.partitionBy("book", "key")
    order = group.orderBy(F.desc("n"), F.length("phrase"), "phrase")
    kind = X.suffix_class(F.element_at(F.split("phrase", "[ -]"), -1))
    ranked = counts.withColumns({"i": F.row_number().over(order), "second": F.lead("n").over(order), "total": F.sum("n").over(group), "kind": kind})
    first = lambda c: F.first(c).over(order.rowsBetween(Window.unboundedPreceding, 0))
    led = ranked.withColumns({"best": first("phrase"), "best_kind": first("kind"), "top": first("n"), "next": first("second")})
    return led.where((F.col("i") > 1) & (F.col("total") >= LEAST_USES) & (F.col("top") >= LEAD * F.col("next")) & (F.col("kind") == F.col("best_kind"))).select("book", F.col("phrase").alias("variant"), "best", "n")


WORD = re.compile(r"[\w-]+")


def rewritten(text: str, best: dict[str, str]) -> tuple[str, int]:
    """The text with its preferred forms and how many places changed: the longest variant that begins at a word gives way.
    A capital at a place's beginning stays."""
    if not best:
        return text, 0
    places = [m.span() for m in WORD.finditer(text)]
    out, at, i, n = [], 0, 0, 0
    while i < len(places):
        start = places[i][0]
        for k in (3, 2, 1):
            form = best.get(text[start : places[i + k - 1][1]].lower()) if i + k <= len(places) else None
            if form:
                out += [text[at:start], form[0].upper() + form[1:] if text[start].isupper() else form]
                at, i, n = places[i + k - 1][1], i + k, n + 1
                break
        else:
            i += 1
    return "".join([*out, text[at:]]), n


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [rewritten(t or "", {m["variant"]: m["best"] for m in (ms or [])}) for t, ms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["id", "text", "replacements"])


def _hash() -> Column:
    return F.xxhash64(F.col("book").cast("string"), "variant")


def _cell() -> Column:
    return F.shiftrightunsigned(_hash(), 64 - CELLS).alias("cell")


def marks(best: DataFrame) -> DataFrame:
    """Bits that the hashes of book and variant set: 2**CELLS rows of 64 at most, however large the table is."""
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    return best.select(_cell(), _hash().alias("h")).groupBy("cell").agg(F.bit_or(bit).alias("marks"))


def harmonised(chapters: DataFrame, best: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key (long), text and replacements of each chapter (key, book, text), rewritten by its book's table. A chapter meets
    the variants that it has, not its book's whole table. That table and the chapters' own ones are stored first, so Spark
    knows how small they are, and neither phrases nor texts are dealt anew where they are; phrases that don't change go at once.
    Where the table is large, phrases are dealt, but only those whose bit a variant has set: none that changes is lost."""
    rows = chapters.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), "book")
    best = stored(best.select("book", "variant", "best"), "forms")
    each = candidates(rows, "id", "book").withColumnRenamed("phrase", "variant").select("id", "book", "variant", _cell(), _hash().alias("h"))
    each = each.join(F.broadcast(marks(best)), "cell").where(F.getbit("marks", F.expr("CAST(h & 63 AS INT)")) == 1)
    used = each.select("id", "book", "variant").join(best, ["book", "variant"])
    lists = stored(used.groupBy("id", "book").agg(F.collect_set(F.struct("variant", "best")).alias("forms")), "used")
    return rows.join(lists, ["id", "book"], "left").select("id", "text", "forms").mapInArrow(_rewrite, "id long, text string, replacements long").withColumnRenamed("id", key)
