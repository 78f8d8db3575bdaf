"""Secret scan: base patterns, and weak candidates reported where the parts of a credential lie together.

A credential has parts: an *identifier* (access key, user, e-mail), a *secret* and an *endpoint*. Base spans (assigned
values, access keys, long hex runs) are reported on their own. Weak candidates are reported only through an interval join:
each part's interval, widened by `reach` code points and cut to its scope (the block between blank lines), is joined with
the intervals of the complementary parts of the same text.

- A weak identifier (a labelled user, an e-mail address, the user of a URL) needs a secret, base or weak.
- A labelled weak secret (a labelled value, a short assigned one, the password of a URL) needs an identifier or an endpoint.
- An unlabelled weak secret (a random-looking token, a hex run of 16 to 31) needs an identifier.
- An endpoint (the host of a URL, a labelled host) needs both.

The join is a sweep over sorted starts and ends, so it emits no pairs, and a text never leaves its batch: nothing is
shuffled, whatever one source or text holds.

Defined results: a null or empty text has no spans; repeated rows fare alike; rows keep their order and number; extra
columns have no influence; an empty table gives an empty result. A text of any length is one record of one task, in time
linear in its length (apart from the sort of its parts). Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _common as C

#: Kinds in the order in which spans of one start are listed; the first three are the base ones.
KINDS = ("assign", "access", "hex", "weak_identifier", "weak_secret", "endpoint")
#: Searched in UTF-8 with A-Z in lower case, which is several times as fast as a search that ignores case.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Least lengths of an assigned value, an access key and a hex run; below them, down to WEAK_VALUE and 16, they are weak.
VALUE_LEN, ACCESS_LEN, HEX_LEN, WEAK_VALUE = 8, 16, 32, 4
#: Labels of weak parts, looked for in the few code points before ":" or "=".
LABEL = re.compile(
    r"""(?<![A-Za-z0-9])(?:(?P<identifier>user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?|e-?mail)"""
    r"""|(?P<secret>pwd|pass(?:phrase|code)?|pin|auth|credential|signature|private_?key|access_?token|key)"""
    r"""|(?P<endpoint>host(?:_?name)?|server|endpoint|base_?url|url))["']?\x20{0,8}\Z""",
    re.I | re.A,
)
LABEL_REACH = 40
SIGN = re.compile(r"""(?<=[A-Za-z"'\x20])[:=]""")
VALUE = re.compile(r"""\x20{0,8}["']?([A-Za-z0-9@+/_.=~!#$%^&*-]{4,})""")
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
URL = re.compile(r"://(?:([^\s/?#@:\"'<>]{1,128}):([^\s/?#@\"'<>]{1,128})@)?([^\s/?#@\"'<>]{1,253})")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}\Z")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
BLANK = re.compile(r"\n[\x20\t\r]*\n")
REACH = 200


class Part(NamedTuple):
    kind: str
    start: int
    end: int
    role: str  # identifier, secret or endpoint
    labelled: bool = True


def assigned(text: str) -> list[tuple[int, int, int]]:
    """Start and end of each assignment, and the length of its value."""
    raw = text.encode("utf-8", "surrogatepass")
    found = [(*m.span(), m.end(1) - m.start(1)) for m in ASSIGN.finditer(raw.lower())]
    if found and len(raw) != len(text):  # a match is of ASCII only: all that stands before it may be longer in bytes
        first = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
        found = [(int(first[a]) - 1, int(first[a]) - 1 + b - a, n) for a, b, n in found]
    return found


def base(text: str) -> list[Part]:
    """The spans that are reported on their own."""
    out = [Part("assign", a, b, "secret") for a, b, n in assigned(text) if n >= VALUE_LEN]
    out += [Part("access", *m.span(), "identifier") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEN]
    return out + [Part("hex", *m.span(), "secret") for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEN]


def weak(text: str) -> list[Part]:
    """Candidates that count only beside their complements."""
    out = [Part("weak_secret", a, b, "secret") for a, b, n in assigned(text) if WEAK_VALUE <= n < VALUE_LEN]
    for m in HEX.finditer(text):
        if m.end() - m.start() < HEX_LEN:
            out.append(Part("weak_secret", *m.span(), "secret", False))
    for m in SIGN.finditer(text):
        near = max(0, m.start() - LABEL_REACH)
        label = LABEL.search(text[near : m.start()])
        value = VALUE.match(text, m.end()) if label else None
        if value:
            role = label.lastgroup
            out.append(Part("endpoint" if role == "endpoint" else "weak_" + role, near + label.start(), value.end(), role))
    url_ends = {}
    if "://" in text:
        for m in URL.finditer(text):
            url_ends[m.end()] = m.start()
            scheme = SCHEME.search(text[max(0, m.start() - 16) : m.start()])
            out.append(Part("endpoint", m.start() - len(scheme[0]) if scheme else m.start(3), m.end(), "endpoint"))
            if m[1]:
                out += [Part("weak_identifier", *m.span(1), "identifier"), Part("weak_secret", *m.span(2), "secret")]
    if "@" in text:  # but for a password and host within a URL
        out += [Part("weak_identifier", *m.span(), "identifier") for m in MAIL.finditer(text) if url_ends.get(m.end(), m.end()) >= m.start()]
    for m in RANDOM.finditer(text):
        t = m[0]
        if any("0" <= c <= "9" for c in t) and t.upper() != t and t.lower() != t:
            out.append(Part("weak_secret", *m.span(), "secret", False))
    return out


def _meets(start: np.ndarray, end: np.ndarray, others: list[Part]) -> np.ndarray:
    """Which intervals overlap one of the others: those that begin before it ends, less those that end before it begins."""
    begins = np.sort(np.array([p.start for p in others], np.int64))
    ends = np.sort(np.array([p.end for p in others], np.int64))
    return np.searchsorted(begins, end, "left") > np.searchsorted(ends, start, "right")


def linked(text: str, strong: list[Part], reach: int = REACH) -> list[Part]:
    """The weak candidates whose complementary parts lie in reach and in the same scope, without those inside a base span."""
    found = sorted(set(weak(text)), key=lambda p: (p.start, p.end, KINDS.index(p.kind), p.labelled))
    if not found:
        return []
    parts = strong + found
    role = {r: [p for p in parts if p.role == r] for r in ("identifier", "secret", "endpoint")}
    cuts = np.array([0, *(m.end() for m in BLANK.finditer(text)), len(text)], np.int64)
    start, end = np.array([p.start for p in found], np.int64), np.array([p.end for p in found], np.int64)
    scope = np.searchsorted(cuts, start, "right")
    low = np.maximum(start - reach, cuts[scope - 1])
    high = np.maximum(np.minimum(end + reach, cuts[np.minimum(np.searchsorted(cuts, end - 1, "right"), len(cuts) - 1)]), end)
    near = {r: _meets(low, high, role[r]) for r in role}
    held = np.zeros(len(found), bool)
    if strong:
        order = sorted(strong, key=lambda p: p.start)
        reached = np.maximum.accumulate([p.end for p in order])
        before = np.searchsorted([p.start for p in order], start, "right")
        held = (before > 0) & (reached[np.maximum(before - 1, 0)] >= end)
    out, said = [], set()
    for i, p in enumerate(found):
        if p.role == "identifier":
            tells = near["secret"][i]
        elif p.role == "secret":
            tells = near["identifier"][i] or (p.labelled and near["endpoint"][i])
        else:
            tells = near["identifier"][i] and near["secret"][i]
        if tells and not held[i] and p[:3] not in said:
            said.add(p[:3])
            out.append(p)
    return out


def _said(parts: list[Part]) -> str:
    return ",".join(f"{p.kind}:{p.start}:{p.end}" for p in sorted(parts, key=lambda p: (p.start, KINDS.index(p.kind), p.end)))


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long,text:string>>"
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """A row for each row of docs: doc_id, base counts and digest, all spans as text, and `found` with kinds and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                ids, texts = batch.column(0)[lo : lo + 1024], batch.column(1)[lo : lo + 1024]
                rows = []
                for x in texts:
                    text = x.as_py() or ""
                    strong = base(text)
                    parts = strong + linked(text, strong, reach)
                    n = [sum(p.kind == k for p in strong) for k in KINDS[:3]]
                    parts.sort(key=lambda p: (p.start, KINDS.index(p.kind), p.end))
                    found = [{"kind": p.kind, "start": p.start, "end": p.end, "text": text[p.start : p.end]} for p in parts]
                    rows.append((*n, hashlib.sha256(_said(strong).encode()).hexdigest(), _said(parts), found))
                cols = list(zip(*rows)) if rows else [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), _FOUND)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    return C.map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), run, RESULT)
