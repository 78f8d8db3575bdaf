"""Folds that link, cite and mark one chapter's or book's markdown. Like the folds of markdown.py each step works on what the
step before left, so they run in Arrow batches, a text a row; null counts as empty."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .markdown import slug

# Words that don't make a title a phrase to link, and how flagged text is marked.
TITLE_STOP = ["introduction", "chapter", "guide", "topic", "section", "with", "from", "this", "that", "into", "their", "your", "general", "basic", "fundamental", "advanced", "and"]
LEAST_PHRASE, LEAST_KEY, KEY_CHARS, LEAST_CLAIM = 8, 20, 120, 15
FLAG, UNVERIFIED = "⚠", "[⚠ UNVERIFIED — not found in source material]"
REFS = "<!-- tool-refs -->"

_CHAPTER = re.compile(r"^##\s+(?:\d+[.)]\s*)?(.+?)\s*$", re.MULTILINE)
_HEADING = re.compile(r"^##\s+(.+?)\s*$", re.MULTILINE)
_CITED = re.compile(r"\[([^\]]+)\]\[tool:([^\]]+)\]")
_OLD_CITED = re.compile(r"\s*\[->\s*Tool Library:[^\]]+\]")


def title_phrases(title: str) -> list[str]:
    """What of a title is linked in other chapters: the whole, then the whole without weak words at its ends."""
    words = re.sub(r"[^\w\s]", " ", title.lower()).split()
    strong = [i for i, w in enumerate(words) if len(w) > 3 and w not in TITLE_STOP]
    if not strong:
        return []
    both = dict.fromkeys([" ".join(words), " ".join(words[strong[0] : strong[-1] + 1])])
    return [p for p in both if len(p) >= LEAST_PHRASE]


def link_chapters(md: str) -> tuple[str, int]:
    """In each chapter the first mention of every other chapter's phrases becomes a link to it."""
    heads = list(_CHAPTER.finditer(md))
    if len(heads) < 2:
        return md, 0
    phrases = [(h[1], slug(h[1]), title_phrases(h[1])) for h in {h[1]: h for h in reversed(heads)}.values()][::-1]
    bounds = [h.end() for h in heads], [h.start() for h in heads[1:]] + [len(md)]
    parts, at, n = [], 0, 0
    for head, begin, end in zip(heads, *bounds, strict=True):
        body = md[begin:end]
        for title, anchor, found in phrases:
            for phrase in found if title != head[1] else ():
                m = re.search(rf"(?<![\[\w-]){re.escape(phrase)}(?![\w\]-])", body, re.IGNORECASE)
                if m:
                    body, n = f"{body[: m.start()]}[{m[0]}](#{anchor}){body[m.end() :]}", n + 1
        parts += [md[at:begin], body]
        at = end
    return "".join(parts), n


def mark_flagged(md: str, title: str, claims: list[str]) -> tuple[str, int]:
    """In the chapter of that heading each flagged claim's first mention gets a mark; white space and stars may differ."""
    heads, n = list(_HEADING.finditer(md)), 0
    for i in reversed([i for i, h in enumerate(heads) if h[1].strip() == title]):
        begin, end = heads[i].start(), heads[i + 1].start() if i + 1 < len(heads) else len(md)
        block = md[begin:end]
        for key in dict.fromkeys(c.strip()[:KEY_CHARS].strip() for c in claims):
            m = re.search(r"[\s*]+".join(map(re.escape, key.split(" "))), block, re.IGNORECASE) if len(key) >= LEAST_KEY else None
            if m:
                block, n = f"{block[: m.end()]} {FLAG}{block[m.end() :]}", n + 1
        md = md[:begin] + block + md[end:]
    return md, n


def strip_citations(md: str) -> str:
    return _CITED.sub(r"\1", _OLD_CITED.sub("", md.split(f"\n\n{REFS}\n")[0]))


def cite_tools(md: str, tools: list[str]) -> tuple[str, int]:
    """Each tool's first mention in a line becomes a reference link, longer names first; definitions follow the text.
    Earlier citations and definitions go first, so that a second run changes nothing."""
    names = sorted(dict.fromkeys(tools), key=lambda t: -len(t))
    lines, n = strip_citations(md).split("\n"), 0
    if not names:
        return md, 0
    for i, line in enumerate(lines):
        if line.startswith(("#", "    ")):
            continue
        for name in names:
            m = re.search(rf"(?<!\[)\b({re.escape(name)}s?)\b(?!\])", line, re.IGNORECASE)
            if m:
                line, n = f"{line[: m.start()]}[{m[1]}][tool:{name}]{line[m.end() :]}", n + 1
        lines[i] = line
    text = "\n".join(lines)
    used = sorted({m[2] for m in _CITED.finditer(text)})
    if used:
        text += f"\n\n{REFS}\n" + "\n".join(f"[tool:{t}]: #tool-{t.replace(' ', '-')}" for t in used) + "\n"
    return text, n


def drop_flagged(md: str, claims: list[str]) -> tuple[str, int]:
    """Sentences that begin with a flagged claim (its first 120 characters) go, up to the end of the sentence."""
    n = 0
    for claim in (c.strip() for c in claims):
        if len(claim) >= LEAST_CLAIM:
            md, k = re.subn(rf"\s*{re.escape(claim[:KEY_CHARS])}[^\n.!?]*[.!?]?", " ", md, flags=re.IGNORECASE)
            n += k
    return (re.sub(r"\n{3,}", "\n\n", re.sub(r" {2,}", " ", md).strip()), n) if n else (md, 0)


def annotate(md: str, keywords: list[list[str]]) -> tuple[str, int]:
    """For each flagged claim the first sentence that holds the longest of its keywords (else the second longest) is marked,
    once a sentence."""
    n = 0
    for words in keywords:
        for word in sorted(words, key=lambda w: -len(w))[:2]:
            m = re.search(rf"[^.!?\n]*{re.escape(word)}[^.!?\n]*[.!?]", md, re.IGNORECASE)
            if m:
                if "[⚠" not in m[0]:
                    at = md.index(m[0]) + len(m[0])
                    md, n = f"{md[:at]} {UNVERIFIED}{md[at:]}", n + 1
                break
    return md, n


_COUNTED = StructType().add("text", StringType()).add("n", IntegerType())


def _lists(values: pd.Series) -> list[list[str]]:
    return [[] if v is None else [x for x in v if x] for v in values]


@F.pandas_udf(_COUNTED)
def link_chapters_udf(md: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([link_chapters(t or "") for t in md], columns=["text", "n"])


@F.pandas_udf(_COUNTED)
def mark_flagged_udf(md: pd.Series, title: pd.Series, claims: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([mark_flagged(t or "", h or "", c) for t, h, c in zip(md, title, _lists(claims), strict=True)], columns=["text", "n"])


@F.pandas_udf(_COUNTED)
def cite_tools_udf(md: pd.Series, tools: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([cite_tools(t or "", x) for t, x in zip(md, _lists(tools), strict=True)], columns=["text", "n"])


@F.pandas_udf(_COUNTED)
def drop_flagged_udf(md: pd.Series, claims: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([drop_flagged(t or "", c) for t, c in zip(md, _lists(claims), strict=True)], columns=["text", "n"])
