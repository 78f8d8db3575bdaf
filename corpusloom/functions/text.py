"""Text functions as column expressions, without Python workers. Plain ones are generated code; those with functions over arrays are
interpreted, so what they use more than once is bound by with_() and computed once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lists import HTML_TAGS, STOP_WORDS

SPACE = r"[ \t\n\r\f\x0B]+"


def arr(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def with_(value: Column, fn) -> Column:
    """fn(value), with value computed once however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def topic_slug(c: Column) -> Column:
    """Letters, digits, _ and - stay; blanks become _; _ at the ends goes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_ \-]", ""), " ", "_"), "^_+|_+$", "")


def slugify(c: Column) -> Column:
    """Anchor of a heading: lower case, punctuation dropped, blanks to -."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9_ \-]", ""), " ", "-")


def hits(text: Column, lexicon: list[str]) -> Column:
    """The entries of a lexicon that a text contains, without regard to case; an entry listed twice counts twice."""
    return with_(F.lower(text), lambda low: F.filter(arr([t.lower() for t in lexicon]), lambda t: F.contains(low, t)))


def density(text: Column, lexicon: list[str]) -> Column:
    return F.size(hits(text, lexicon))


def windows(text: Column, width: int = 5000) -> Column:
    """Head, middle and tail of a long text; a short one (up to three widths) whole."""
    n = F.length(text)
    mid = (F.floor(n / 2) - width // 2).cast("int")
    return F.when(n <= 3 * width, F.array(text)).otherwise(F.array(F.substring(text, 1, width), text.substr(mid + 1, F.lit(width)), text.substr((n - width + 1).cast("int"), F.lit(width))))


def window_density(text: Column, lexicon: list[str], width: int = 5000) -> Column:
    """Sum of the windows' densities (all three are added, not the best two); 0 where fewer than two have any."""

    def total(each: Column) -> Column:
        with_any = F.size(F.filter(each, lambda x: x > 0))
        return F.when((F.size(each) == 1) | (with_any >= 2), F.aggregate(each, F.lit(0), lambda a, x: a + x)).otherwise(0)

    return with_(F.transform(windows(text, width), lambda w: density(w, lexicon)), total)


def share(part: Column, whole: Column) -> Column:
    """part / whole; of nothing it isn't a number, and no error."""
    return F.when(whole == 0, F.lit(float("nan"))).otherwise(F.try_divide(part, whole))


def letter_ratio(text: Column) -> Column:
    return share(F.length(F.regexp_replace(text, r"\P{L}", "")), F.length(text))


def looks_like_html(text: Column) -> Column:
    return with_(F.lower(F.substring(text, 1, 2000)), lambda head: F.exists(arr(HTML_TAGS), lambda t: F.contains(head, t)))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def ocr_metrics(text: Column) -> Column:
    """n tokens, their mean length, the share that look like words, and the share of short lines. What is neither letter nor
    white space becomes one sign, in one pass over the text, so that no word is searched by itself."""

    def measured(x: Column) -> Column:
        t, lines = x["t"], x["lines"]
        n = F.size(t)
        chars = F.aggregate(t, F.lit(0).cast("bigint"), lambda a, w: a + F.length(w))
        real = F.size(F.filter(t, lambda w: (F.length(w) >= 2) & (F.length(F.replace(w, F.lit("\x01"), F.lit(""))) / F.length(w) >= 0.6)))
        short = F.size(F.filter(lines, lambda x: F.length(x) < 15))
        return F.struct(n.alias("n"), F.try_divide(chars, n).alias("mean_length"), share(real, n).alias("real_share"), share(short, F.size(lines)).alias("short_lines"))

    lines = lambda signs: F.filter(F.transform(F.split(signs, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\f"))), lambda x: x != "")
    signs = F.regexp_replace(text, r"[^\p{L} \t\n\r\f\x0B]", "\x01")
    return with_(with_(signs, lambda s: F.struct(tokens(s).alias("t"), lines(s).alias("lines"))), measured)


def bad_window(text: Column) -> Column:
    return with_(ocr_metrics(text), lambda m: (m["n"] >= 50) & ((m["mean_length"] < 3.0) | (m["real_share"] < 0.55) | (m["short_lines"] > 0.7)))


def ocr_garbage(text: Column) -> Column:
    """Two or more of three windows look like failed recognition; texts under 3000 characters pass. A middle window that
    would begin before the text begins counts from its end, as a negative slice does."""
    n = F.length(text)
    mid = F.floor(n / 2).cast("int")
    begin = F.when(mid < 3000, n + mid - 3000).otherwise(mid - 3000)
    parts = F.array(text.substr(F.lit(2001), F.lit(6000)), text.substr(begin + 1, F.least(mid + 3000, n) - begin), text.substr(F.greatest(n - 5999, F.lit(1)), F.lit(6000)))
    return (n >= 3000) & (F.size(F.filter(F.transform(parts, bad_window), lambda x: F.coalesce(x, F.lit(False)))) >= 2)


def strip_scan_notice(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"Digitized by [^\n]*?\n", ""), r"^\s+|\s+$", "")


def occurrences(text: Column, term: Column) -> Column:
    """Non-overlapping occurrences of a plain term."""
    return ((F.length(text) - F.length(F.replace(text, term, F.lit("")))) / F.length(term)).cast("int")


def topic_density(text: Column, term: str) -> Column:
    """Occurrences of a term for each 100 words."""
    return occurrences(F.lower(text), F.lit(term)) / F.greatest(word_count(text), F.lit(1)) * 100


def headings(text: Column, most: int = 25) -> Column:
    """Titles of lines that begin with one to four # and a blank, or with == or more; the first ones."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\f\x0b")))
    marked = F.filter(lines, lambda x: x.rlike(r"^#{1,4}\s+\S|^={2,}\s*[^\s=]"))
    return F.slice(F.transform(marked, lambda x: F.btrim(F.when(x.startswith("#"), F.regexp_replace(x, "^#+", "")).otherwise(F.replace(x, F.lit("="), F.lit(""))), F.lit(" \t\r\f\x0b"))), 1, most)


def sentences(text: Column) -> Column:
    """Split after . ! or ? where white space and a capital or digit follow."""
    return F.split(text, r"(?<=[.!?])\s+(?=[A-Z0-9])")


def chunks(text: Column, k: int = 300) -> Column:
    """Chunks of k words."""

    def cut(t: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor((F.size(t) - 1) / k).cast("int"))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(F.transform(steps, lambda i: F.array_join(F.slice(t, i * k + 1, F.lit(k)), " ")))

    return with_(tokens(text), cut)


MARKER = r"\[C\d+(?:[, ]+C\d+)*\]"


def marker_ids(text: Column) -> Column:
    """Ids of claim markers such as [C7] and [C1, C2], in order, repeats kept."""
    return F.transform(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(f"({MARKER})"), 1), lambda m: F.regexp_extract_all(m, F.lit(r"(\d+)"), 1))), lambda x: x.cast("int"))


def strip_markers(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, rf"\s*{MARKER}", ""), r"[ \t]{2,}", " "), r" +([.,;:!?])", "$1")


UNITS = "mm|cm|m|in|inch|inches|ft|kg|g|lb|lbs|oz|°C|°F|°|psi|rpm|mW|W|V|%"
SPECIFIC = rf"\d+(?:\.\d+)?(?:\s?[-–]\s?\d+(?:\.\d+)?)?[ -]?(?:{UNITS})(?![A-Za-z])"


def specifics(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({SPECIFIC})"), 1)


NUMBER = r"\d+(?:[.,]\d+)?"
VALUE = rf"{NUMBER}(?:\s*[-–]\s*{NUMBER})?"
PAIR_UNIT = r"°C|°F|mm|inches|inch|in|kg|lb|oz"
#: The second quantity is looked at without being used up: it may be the first of the next pair.
PAIR = rf"(?U)({VALUE})\s*({PAIR_UNIT})(?=\s*[/(,]\s*({VALUE})\s*(°C|°F|mm|inches\b|inch\b|in\b|kg|lb|oz\b))"


def range_ends(c: Column) -> tuple[Column, Column]:
    """The numbers of "a-b" as strings, empty ones where there is none; a comma is a decimal point."""
    x = F.replace(c, F.lit(","), F.lit("."))
    return F.regexp_extract(x, r"^\s*(\d+(?:\.\d+)?)", 1), F.regexp_extract(x, r"^\s*\d+(?:\.\d+)?\s*[-–]\s*(\d+(?:\.\d+)?)", 1)


def as_number(c: Column) -> Column:
    """Null for an empty string, which isn't cast: a cast that fails raises and catches an exception."""
    return F.when(c != "", c.try_cast("double"))


def mean_of_ends(low: Column, high: Column) -> Column:
    """The mean of both range_ends(), or the first if there is one only."""
    return (as_number(low) + F.coalesce(as_number(high), as_number(low))) / 2


def range_average(c: Column) -> Column:
    """The mean of "a-b", or the number of "a"; a comma is a decimal point."""
    return mean_of_ends(*range_ends(c))


def lemma(word: Column) -> Column:
    """First of ing, ed, ies (to y), es and s taken off words of five letters or more."""
    w = F.lower(word)
    return (
        F.when(F.length(w) < 5, w).when(w.endswith("ing"), F.regexp_replace(w, "ing$", "")).when(w.endswith("ed"), F.regexp_replace(w, "ed$", ""))
        .when(w.endswith("ies"), F.regexp_replace(w, "ies$", "y")).when(w.endswith("es"), F.regexp_replace(w, "es$", "")).when(w.endswith("s"), F.regexp_replace(w, "s$", "")).otherwise(w)
    )


def phrase_key(phrase: Column) -> Column:
    return F.array_join(F.transform(F.split(F.replace(F.lower(phrase), F.lit("-"), F.lit(" ")), " +"), lemma), " ")


def suffix_class(word: Column) -> Column:
    w = F.lower(word)
    return F.when(w.endswith("ing"), "gerund").when(w.endswith("ed"), "past").when(w.endswith("s") & (F.length(w) > 4) & ~w.endswith("ss"), "plural").otherwise("base")


def signature(text: Column) -> Column:
    """Distinct words of four letters and more, without stop words."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b([a-z]{4,})\b"), 1)), arr(STOP_WORDS))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


URL = r"https?://[^\s\"'<>)\]]+"


def urls(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(f"({URL})"), 1), lambda u: F.regexp_replace(u, r"[.,;:!?]+$", ""))
    return F.filter(found, lambda u: (F.length(u) >= 12) & (F.length(u) <= 500))


def domain(url: Column) -> Column:
    """Host in lower case, with any of the letters w and . taken off its left end, as the rule being matched does."""
    return F.ltrim(F.lower(F.regexp_extract(url, r"^https?://([^/?#]+)", 1)), F.lit("w."))


def tags_to_text(html: Column) -> Column:
    """Markup to text by patterns: unwanted elements, then tags, then entities, then white space."""
    x = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|header|aside|form)[^>]*>.*?</(?:script|style|nav|footer|header|aside|form)>", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"&[#a-zA-Z0-9]+;", " "), r"\s+", " "))


def first_words(c: Column, n: int = 6) -> Column:
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def mentions(text: Column, phrase: Column) -> Column:
    """A phrase occurs as whole words, without regard to case."""
    low = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "), F.lit(" "))
    return F.contains(low, F.concat(F.lit(" "), F.lower(phrase), F.lit(" ")))


def strip_think(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<think>.*?</think>", "")


def model_json(text: Column) -> Column:
    """JSON in a model's answer: the whole, else the widest {...}, else the widest [...], else null."""
    x = F.btrim(F.regexp_replace(strip_think(text), r"```(?:json)?", ""))
    part = lambda p: F.try_parse_json(F.nullif(F.regexp_extract(x, p, 1), F.lit("")))
    return F.coalesce(F.try_parse_json(x), part(r"(?s)(\{.*\})"), part(r"(?s)(\[.*\])"))


def clean_artefacts(text: Column) -> Column:
    """A model's fences, opening phrases, tags and leading title taken out of a chapter."""
    x = F.regexp_replace(text, r"(?m)^```[a-z]*\s*$", "")
    x = F.regexp_replace(x, r"(?i)^\s*(here is|sure|certainly)[^\n]*\n", "")
    x = F.regexp_replace(x, r"\[(?i:unverified)\]|\(?VOL_[A-Za-z0-9_]+(?:\.txt)?\)?", "")
    return F.btrim(F.regexp_replace(x, r"^\s*# [^\n]*\n", ""))


def latin1(text: Column) -> Column:
    """Markdown marks dropped, common typographic signs replaced, other signs beyond Latin-1 to ?."""
    x = F.regexp_replace(F.regexp_replace(text, r"\*\*|__|`", ""), r"(?m)^#+\s*", "")
    x = F.translate(x, "‘’“”–—•−×", "''\"\"--*-x")
    return F.regexp_replace(F.replace(x, F.lit("…"), F.lit("...")), r"[^\x00-\xFF]", "?")
