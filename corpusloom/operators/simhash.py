"""Fingerprints and near-duplicates of long texts.

A fingerprint takes each window of six characters, its Adler-32 value h, and the 64-bit word (h << 32) | (h ^ 0x55555555);
a bit is set where more than half of the windows have it. Texts under six characters have fingerprint 0.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.lists import HAMMING, SHORT_LIMIT

WINDOW_CHARS = 6
#: Windows of a text whose values are held at once.
BLOCK = 1 << 16


def votes(text: str) -> tuple[np.ndarray, int]:
    """For each of 32 bits, the windows whose Adler-32 value has it; and the number of windows. They are taken in blocks, as
    their values need some hundred times the room of the text."""
    n = max(len(text) - WINDOW_CHARS + 1, 0)
    total = np.zeros(32, np.int64)
    for i in range(0, n, BLOCK):
        total += _votes(text[i : i + BLOCK + WINDOW_CHARS - 1])
    return total, n


def _votes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    start = np.r_[np.flatnonzero((data & 0xC0) != 0x80), len(data)]
    n = len(start) - WINDOW_CHARS
    total, moment = np.r_[0, np.cumsum(data)], np.r_[0, np.cumsum(data * np.arange(len(data)))]
    a, b = start[:n], start[WINDOW_CHARS:][:n]
    s = total[b] - total[a]
    low = (1 + s) % 65521
    high = (b - a + b * s - (moment[b] - moment[a])) % 65521
    h = (high << 16) | low
    return np.array([int(((h >> i) & 1).sum()) for i in range(32)])


def fingerprint_of(text: str | None) -> int:
    v, n = votes(text or "")
    out = 0
    for i in range(32):
        out |= (2 * int(v[i]) > n) << (32 + i)
        out |= (2 * int(n - v[i] if i % 2 == 0 else v[i]) > n) << i
    return out - (1 << 64) if out >> 63 else out


@F.pandas_udf(LongType())
def simhash(text: pd.Series) -> pd.Series:
    return text.map(fingerprint_of).astype("int64")


def fingerprints(docs: DataFrame, least: int = SHORT_LIMIT) -> DataFrame:
    """doc_id, topic, size (bytes) and fp (the 64 bits as a signed number) of texts that are long enough to compare."""
    return docs.where(F.length("text") >= least).select("doc_id", F.col("lang").alias("topic"), F.octet_length("text").alias("size"), simhash("text").alias("fp"))


def kept(docs: DataFrame, order: list, store) -> DataFrame:
    """topic, doc_id and fp of the documents kept: short ones always, without a fingerprint, the others by greedy_keep()."""
    short = docs.where(F.length("text") < SHORT_LIMIT).select(F.col("lang").alias("topic"), "doc_id", F.lit(None).cast("long").alias("fp"))
    return greedy_keep(store(fingerprints(docs)), order, store).unionByName(short)


def bands(prints: DataFrame, most: int = HAMMING) -> DataFrame:
    """topic, fp, band and key of each fingerprint. Of most + 2 groups of bits (every sixth bit) two at least must be equal in
    fingerprints within `most` bits, so these share a band and its key: two groups, of 20 bits or more together."""
    masks = [sum(1 << b for b in range(64) if b % (most + 2) in two) for two in combinations(range(most + 2), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return prints.select("topic", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("band", "key"))


def near_pairs(prints: DataFrame, most: int = HAMMING) -> DataFrame:
    """Pairs a < b of different fingerprints of a topic within `most` bits. They meet by their bands; equal fingerprints
    are one row before they meet."""
    both = bands(prints.select("topic", "fp").distinct(), most)
    a, b = both.withColumnRenamed("fp", "a"), both.withColumnRenamed("fp", "b")
    return a.join(b, ["topic", "band", "key"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)).select("topic", "a", "b").distinct()


def greedy_keep(prints: DataFrame, order: list, store) -> DataFrame:
    """The rows kept by going through a topic in the order of the columns `order` and dropping what is within reach of a row kept before. Rounds:
    a fingerprint with no undecided or kept one before it is kept, those after it in reach are dropped. Rounds end with
    the longest chain; `store` cuts the lineage of each."""
    first = F.min(F.struct(F.struct(*order).alias("rank"), "doc_id"))
    heads = store(prints.groupBy("topic", "fp").agg(first.alias("x")).select("topic", "fp", "x.doc_id", "x.rank"))
    pairs = near_pairs(prints)
    both = pairs.select("topic", "a", "b").unionByName(pairs.select("topic", F.col("b").alias("a"), F.col("a").alias("b")))
    r = heads.select("topic", "fp", "rank")
    edges = store(
        both.join(r.select("topic", F.col("fp").alias("a"), F.col("rank").alias("ra")), ["topic", "a"]).join(r.select("topic", F.col("fp").alias("b"), F.col("rank").alias("rb")), ["topic", "b"])
        .where("ra < rb").select("topic", F.col("a").alias("early"), F.col("b").alias("late"))
    )
    state = heads.select("topic", "fp", F.lit(0).alias("state"))  # 0 undecided, 1 kept, 2 dropped
    while True:
        early = state.select("topic", F.col("fp").alias("early"), F.col("state").alias("s"))
        seen = edges.join(early, ["topic", "early"]).groupBy("topic", F.col("late").alias("fp")).agg(F.max(F.col("s") == 1).alias("hit"), F.max(F.col("s") == 0).alias("wait"))
        state = store(
            state.join(seen, ["topic", "fp"], "left")
            .select("topic", "fp", F.when(F.col("state") != 0, F.col("state")).when(F.coalesce("hit", F.lit(False)), 2).when(F.coalesce("wait", F.lit(False)), 0).otherwise(1).alias("state"))
        )
        if state.where("state = 0").isEmpty():
            return heads.join(state.where("state = 1"), ["topic", "fp"]).select("topic", "doc_id", "fp")
