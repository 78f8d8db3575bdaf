"""Phrase collocations against a plain count, odd rows, windows of long texts."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusloom.llm import _common as C
from corpusloom.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall("[^\\x20\\x09]+", p) for p in re.split("[.,;:!?\\x0a-\\x0d]", (text or "").translate(LOWER))]


def counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least, top):
    f, n = counts(rows)
    c = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for lang in n:
        best = []
        for p, a in c.items():
            if p[0] != lang:
                continue
            w = p[1:]
            longer = [b for q, b in c.items() if q[0] == lang and len(q) > len(p) and any(q[i : i + len(w)] == w for i in range(1, len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[: k + 1]] + f[(lang, *w[k:])]), k, f[p[: k + 1]], f[(lang, *w[k:])]) for k in range(1, len(w)))
            best.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def fixture(n=150):
    r = random.Random(5)
    vocabulary = ["The", "of", "thé", "RE", "\u00c9", "x-y", "'s", "on", "re", "(a)", "\u2003", "\x00", "\x85"]
    lines = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(3, 7))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [r.choice(lines) if r.random() < 0.5 else " ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 12))) for _ in range(r.randrange(0, 6))]
        rows.append((r.choice(["en", "de", "en", None, ""]), "".join(p + r.choice([".", " ", ", ", "\n", "\t", "  !? "]) for p in parts)))
    return rows + [("en", None), (None, ""), ("und", lines[0]), rows[3], rows[3], ("xx", ".,;"), ("yy", "one")]


def test_against_a_plain_count(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, x, i, 0.5) for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, f long, `w.x` double").repartition(5)
    for least, top in ((30, 2000), (8, 7), (2, 2000)):
        got = sorted(tuple(r) for r in phrases.mine(df, least, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
        assert got == plain(rows, least, top)
    assert phrases.mine(df.where("false")).count() == 0


def test_a_crowded_table_of_bits_changes_nothing(spark):
    rows = fixture(60)
    df = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string").repartition(3)
    assert sorted(map(tuple, phrases.frequent(df, 5, bits=6).collect())) == sorted(map(tuple, phrases.frequent(df, 5).collect()))


def test_windows_count_each_word_once():
    r = random.Random(3)
    text = "".join(r.choice(["ab", "c", "longer", "é", "z" * 90]) + r.choice([" ", " ", " ", "\t", ". ", "\n"]) for _ in range(900))
    for texts, size in (([text], 64), ([text], 300), (["a b", text, "", "c d e"], 128), ([text[:50], text[:50]], 1 << 20)):
        data, off = C.text_bytes(pa.array(texts))
        got = Counter()
        for part, w, owned, first in phrases.windows(data, off, size):
            _, number = phrases.numbered(part, w, np.zeros(len(w.start), np.uint64))
            said = [part[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
            for n, place, count in phrases.ngrams(number, w.rest, owned):
                for i, c in zip(place.tolist(), count.tolist()):
                    got[("", *said[i : i + n])] += c
        assert got == counts([("", t) for t in texts])[0]
