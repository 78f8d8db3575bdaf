"""Ordered folds over one chapter's markdown. Each step depends on the text the step before left, so they run in Arrow
batches, a chapter a row; null counts as empty. Era flags need no order and stay a column expression."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .lists import CONVERSIONS
from .text import NUMBER, PAIR

# Words that mark a practice as historical or modern.
HISTORICAL = [
    r"\bin (?:ancient|early|medieval|historical) (?:times|practice|method)\b",
    r"\b(?:traditionally|historically)\b",
    r"\b(?:in the )?(?:nineteenth|twentieth|18\d{2}|19\d{2})s? century\b",
    r"\bbefore the (?:industrial|modern) (?:era|age|revolution)\b",
    r"\b(?:was|were) (?:once|formerly) used\b",
]
MODERN = [r"\b(?:today|modern|contemporary|currently|nowadays)\b", r"\b21st century\b", r"\bcommercial(?:ly)? available\b"]
# What counts as a specific value of a sentence, and sections that are not held against claims.
NUMBER_UNIT = (
    r"\b(\d+(?:[\.,]\d+)?(?:\s*[-–]\s*\d+(?:[\.,]\d+)?)?)\s*(°[CF]|°|%|mm|cm|m|km|in|inch|inches|ft|kg|g|lb|oz|psi|bar|amps?|A|V|hz|hp|rpm|"
    r"sec(?:onds?)?|min(?:utes?)?|hr|hours?|days?|weeks?|months?|years?|gauge|grit|gsm)\b"
)
YEAR = r"\b(?:1[5-9]\d{2}|20[0-2]\d)s?\b|\b(?:early|mid|late)\s+\d+(?:st|nd|rd|th)\s+century\b|\b\d+(?:st|nd|rd|th)\s+century\b"
STANDARD = r"\b(?:ASTM|ANSI|AISI|ISO|EN|DIN|JIS|MIL|NFPA|OSHA|NIOSH|UL|CE)[\s-]?[A-Z]?\d+[A-Z0-9-]*\b"
EXEMPT = ["try this", "review questions", "answer key", "learning outcomes", "summary", "key takeaways"]
# Two to four capitalised words, those that name nothing, and words that a name doesn't begin with.
NAMED = r"\b([A-Z][a-z]+(?:[\s-][A-Z][a-z]+){1,3})\b"
NAMELESS = [
    "learning outcomes", "review questions", "answer key", "try this", "key takeaways", "summary", "common mistake", "safety", "tip", "section", "chapter", "introduction", "conclusion", "table of contents", "see also",
    "by the end", "in this chapter", "for example", "north america", "south america", "middle east", "west africa", "north", "south", "east", "west", "you can", "you will", "you should", "they are", "this is", "the same",
    "the most", "the best", "the right",
]
POINTERS = ["the", "a", "an", "this", "that", "these", "those"]
TOLERANCE, UNIT_WITHIN, LEAST_SENTENCE = 0.15, 30, 20


def cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def plain(cell: str) -> str:
    return cell[2:-2].strip() if len(cell) >= 4 and cell.startswith("**") and cell.endswith("**") else cell


def _is_row(line: str) -> bool:
    return len(line.rstrip()) >= 3 and line.startswith("|") and line.rstrip().endswith("|")


def _row_text(head: list[str], row: list[str]) -> str | None:
    """One table row as list text, by the number of columns; null for rows that are short or empty."""
    width = len(head)
    if width == 1:
        return f"- {plain(row[0])}"
    if width >= 4:
        if not any(row):
            return None
        named = zip(head[1:], row[1:], strict=False)
        return "\n".join([f"\n**{plain(row[0])}**", *(f"- *{plain(h).rstrip(':')}:* {v}" for h, v in named if v)])
    lead, rest = plain(row[0]), row[1:width]
    if len(row) < width or not (lead or any(rest)):
        return None
    if width == 2:
        return f"- **{lead}** — {rest[0]}"
    stop = "" if not rest[0] or rest[0].endswith((".", "!", "?", ";")) else "."
    return f"- **{lead}** — {rest[0]}{stop}" + (f" *{plain(head[2]).rstrip(':')}:* {rest[1]}" if rest[1] else "")


def tables_to_lists(md: str) -> tuple[str, int]:
    """Each table (a head, a rule line, then rows) becomes a list; returns the text and the number of tables."""
    lines, out, i, done = md.split("\n"), [], 0, 0
    while i < len(lines):
        rule = lines[i + 1] if i + 1 < len(lines) else ""
        if _is_row(lines[i]) and _is_row(rule) and not set(rule.strip()) - set("|-: \t") and i + 2 < len(lines) and _is_row(lines[i + 2]):
            end = i + 2
            while end < len(lines) and _is_row(lines[end]):
                end += 1
            head = cells(lines[i])
            out += [x for x in (_row_text(head, cells(r)) for r in lines[i + 2 : end]) if x is not None]
            done, i = done + 1, end
        else:
            out.append(lines[i])
            i += 1
    return "\n".join(out), done


def slug(term: str) -> str:
    return re.sub(r"\s+", "-", re.sub(r"[^\w\s-]", "", term.lower().strip()))


def link_terms(md: str, terms: list[str]) -> tuple[str, int]:
    """The first mention of each term outside headings, code and table rules becomes a link to its glossary entry. Longer
    terms are placed first in a line, and a term within an existing link is left."""
    open_terms = {t.lower(): t for t in sorted(set(terms), key=lambda t: (len(t), t))}
    order = sorted(open_terms, key=lambda t: (-len(t), t))
    out, code, n = [], False, 0
    for line in md.split("\n"):
        fence = line.strip().startswith("```")
        code ^= fence
        if not (fence or code or line.startswith("#") or line.strip().startswith("|---")):
            for low in [t for t in order if t in open_terms and t in line.lower()]:
                found = re.search(rf"(?<![\[\w-])({re.escape(low)})(?![\w\]-])", line, re.IGNORECASE)
                if found:
                    line = f"{line[: found.start()]}[{found[1]}](#glossary-{slug(open_terms.pop(low))}){line[found.end() :]}"
                    n += 1
        out.append(line)
    return "\n".join(out), n


def expand_acronyms(md: str, uses: int = 3) -> tuple[str, int]:
    """The first uses of an acronym in a chapter carry its long form, later ones lose it. The long form is the first that
    the book gives; text before the first chapter stays."""
    long_form: dict[str, str] = {}
    for short, full in re.findall(r"\b([A-Z]{2,6})\s*\(([^)]{3,80})\)", md):
        if len(full.strip()) > 3:
            long_form.setdefault(short, full.strip())
    if not long_form:
        return md, 0
    known = re.compile(rf"\b({'|'.join(sorted(map(re.escape, long_form), key=len, reverse=True))})\b(\s*\((?:([^)]*)\))?)?")
    changed = 0

    def chapter(text: str) -> str:
        seen: Counter[str] = Counter()

        def use(m: re.Match) -> str:
            nonlocal changed
            seen[m[1]] += 1
            if seen[m[1]] <= uses and m[2] is None:
                changed += 1
                return f"{m[1]} ({long_form[m[1]]})"
            if seen[m[1]] > uses and m[3] == long_form[m[1]]:
                changed += 1
                return m[1]
            return m[0]

        return known.sub(use, text)

    first, *rest = re.split(r"(?m)^(?=##\s+\S)", md)
    return first + "".join(map(chapter, rest)) if not md.startswith("##") else "".join(map(chapter, [first, *rest])), changed


class ClaimIndex:
    """What the claims of a chapter state: their text, and their numbers in order with the text around each."""

    def __init__(self, claims: list[str]):
        self.text = " || ".join(c.lower() for c in claims)
        self.tight = self.text.replace(" ", "")
        found = sorted((float(m[1]), m.start(), m.end()) for m in re.finditer(r"\b(\d+(?:\.\d+)?)\b", self.text))
        self.values = [v for v, _, _ in found]
        self.around = [self.text[max(0, a - UNIT_WITHIN) : b + UNIT_WITHIN] for _, a, b in found]

    def states(self, value: str, unit: str) -> bool:
        """The value stands in a claim as written, or a number within 15 % of it (of a range's ends) with the unit near."""
        unit, bare = unit.lower().strip(), value.strip().replace(" ", "")
        if bare + unit in self.tight or f"{bare} {unit}" in self.text:
            return True
        ends = re.match(r"(\d+(?:\.\d+)?)(?:\s*[-–]\s*(\d+(?:\.\d+)?))?", value)
        low, high = float(ends[1]), float(ends[2] or ends[1])
        at = bisect_left(self.values, low * (1 - TOLERANCE))
        while at < len(self.values) and self.values[at] <= high * (1 + TOLERANCE):
            if unit in self.around[at]:
                return True
            at += 1
        return False


_NAMED, _NAMELESS = re.compile(NAMED), frozenset(NAMELESS)
_UNITS, _YEARS, _STANDARDS = re.compile(NUMBER_UNIT, re.IGNORECASE), re.compile(YEAR, re.IGNORECASE), re.compile(STANDARD)
_HEADER = re.compile(r"^#{2,4}\s", re.MULTILINE)
_EXEMPT = re.compile(rf"^#{{2,4}}\s*(?:🔧\s*)?(?:{'|'.join(EXEMPT)})\b", re.IGNORECASE | re.MULTILINE)


def unsupported(sentence: str, index: ClaimIndex) -> bool:
    return (
        any(not index.states(m[1], m[2]) for m in _UNITS.finditer(sentence))
        or any(m[0].lower() not in index.text for m in _YEARS.finditer(sentence))
        or any(m[0].lower() not in index.text for m in _STANDARDS.finditer(sentence))
    )


_PAIRS = re.compile(PAIR.removeprefix("(?U)"))
_RULES = {(a, b): (factor, shift, single) for a, b, factor, shift, single in CONVERSIONS}


def misconverted(sentence: str) -> bool:
    """Two neighbouring quantities say they are the same in two units, and are not within 15 %."""
    for a, x, b, y in _PAIRS.findall(sentence):
        rule = _RULES.get(("in" if x.startswith("inch") else x, "in" if y.startswith("inch") else y))
        ends = [[float(v.replace(",", ".")) for v in re.findall(NUMBER, q)] for q in (a, b)]
        if rule is None or rule[2] and len(ends[1]) > 1:
            continue
        first = ends[0][-1:] if rule[2] else ends[0]
        want = sum(first) / len(first) * rule[0] + rule[1]
        if first[0] and want and abs(want - sum(ends[1]) / len(ends[1])) > TOLERANCE * abs(want):
            return True
    return False


def unknown_names(sentence: str, index: ClaimIndex) -> int:
    """Names after a sentence's first word that no claim has: a signal only."""
    _, _, rest = sentence.partition(sentence.split(maxsplit=1)[0])
    found = (m[1].lower() for m in _NAMED.finditer(rest))
    return sum(n not in index.text for n in found if n not in _NAMELESS and n.split()[0] not in POINTERS and len(n.split()) > 1)


def drop_unsupported(md: str, claims: list[str]) -> tuple[str, int, int, int]:
    """Prose sentences of 20 characters or more that name a value, year or standard which no claim states, or convert a
    quantity wrongly, go. Headings,
    quotes, code, tables, lists and exercise sections stay. Without claims the text stays. Returns the text, the sentences
    looked at, those dropped, and the names in the others that no claim has."""
    if not claims:
        return md, 0, 0, 0
    index, out, exempt, seen, dropped, names = ClaimIndex(claims), [], False, 0, 0, 0
    for block in md.split("\n\n"):
        body = block.strip()
        if _HEADER.search(body):
            exempt = bool(_EXEMPT.search(body)) or (exempt and not body.startswith("##"))
        if not body:
            continue
        if exempt or body.startswith(("#", ">", "```", "|", "-", "*", "1.", "2.", "3.")):
            out.append(block)
            continue
        kept = []
        for s in re.split(r"(?<=[.!?])\s+(?=[A-Z\d])", block):
            long = len(s.strip()) >= LEAST_SENTENCE
            bad = long and (misconverted(s.strip()) or unsupported(s.strip(), index))
            seen, dropped = seen + long, dropped + bad
            names += unknown_names(s.strip(), index) if long and not bad else 0
            kept += [] if bad else [s]
        if kept:
            out.append(" ".join(kept).strip())
    return re.sub(r"\n{3,}", "\n\n", "\n\n".join(x for x in out if x.strip())).strip(), seen, dropped, names


# types as objects: a type as text needs a session when the module is imported
_COUNTED = StructType().add("text", StringType()).add("n", IntegerType())
_FILTERED = StructType().add("text", StringType()).add("seen", IntegerType()).add("dropped", IntegerType()).add("names", IntegerType())


@F.pandas_udf(_COUNTED)
def tables_to_lists_udf(md: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([tables_to_lists(t or "") for t in md], columns=["text", "n"])


@F.pandas_udf(_COUNTED)
def link_terms_udf(md: pd.Series, terms: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([link_terms(t or "", [] if x is None else list(x)) for t, x in zip(md, terms, strict=True)], columns=["text", "n"])


@F.pandas_udf(_COUNTED)
def expand_acronyms_udf(md: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([expand_acronyms(t or "") for t in md], columns=["text", "n"])


@F.pandas_udf(_FILTERED)
def drop_unsupported_udf(md: pd.Series, claims: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([drop_unsupported(t or "", [] if c is None else [x or "" for x in c]) for t, c in zip(md, claims, strict=True)], columns=["text", "seen", "dropped", "names"])


def flag_era(md: Column) -> Column:
    """Paragraphs of 80 characters or more with two historical marks and no modern one get a quote mark that says so."""
    count = lambda p, marks: F.regexp_count(p, F.lit("(?i)" + "|".join(marks)))

    def one(p: Column) -> Column:
        body = F.regexp_replace(p, r"^\s+|\s+$", "")
        fits = (F.length(body) >= 80) & ~body.rlike(r"^(?:[#*>|-]|```)") & ~body.rlike("(?:Historical|Modern) practice:")
        return F.when(fits & (count(body, HISTORICAL) >= 2) & (count(body, MODERN) == 0), F.concat(F.lit("> ⏳ **Historical practice:** "), body)).otherwise(p)

    return F.array_join(F.transform(F.split(md, "\n\n"), one), "\n\n")
