"""WARC archives: write pages as records, and read archives back by boundary-chain verification.

write() makes a record of each page with string functions and Spark's text writer, whose line separator is the blank
lines that end a record; so archives go to any store that Spark writes, and nothing is collected. Of pages with equal
payloads the one with the largest page_id is a response, the others revisit it.

read() cuts the archives at each magic line and emits a candidate (offset of the record, offset of its successor by
Content-Length) for each. Magic inside a payload makes false candidates. Pointer jumping from the file's start, within
byte splits and then over the splits of an archive, retains the records that the chain reaches, in logarithmically many
rounds. Payload digests of responses are verified; a payload that holds magic is put together from its pieces.

Defined results: a null payload is empty; a null page_id is smaller than all others (a group of such pages only is all
response); equal page_ids with equal payloads are responses alike; an empty table makes no archive and reads as no rows.
A record must fit a row; an archive need not fit a task, and a compressed one, which can't be split, is read as a stream.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _common as C

MAGIC = b"WARC/1.0\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = 2048


def base32_sha1(payload: F.Column) -> F.Column:
    """SHA-1 in bare upper-case base32: five hexadecimal digits are four of base 32."""
    h = F.sha1(payload)
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """A record, as text, of each of pages (page_id, url, html)."""
    html = F.coalesce(pages["html"], F.lit(""))
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("size"), base32_sha1(html).alias("digest"))
    # one row for each payload that comes more than once, and never for those too small to be shared
    keep = p.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "first")
    p = p.join(keep, p["digest"] == keep["d"], "left")
    revisit = F.col("d").isNotNull() & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    address = F.regexp_replace(F.col("url"), r"[\r\n]", " ")
    head = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", uri(F.col("page_id"))),
        F.when(F.col("url").isNull(), "").otherwise(line("WARC-Target-URI", address)), line("WARC-Date", F.lit("1970-01-01T00:00:00Z")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", uri(F.col("first"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"),
    )
    return p.select(F.concat(head, body).alias("value"))


def write(pages: DataFrame, path: str, least: int = 0, compression: str = "gzip") -> None:
    records(pages, least).write.option("lineSep", "\r\n\r\n").option("compression", compression).option("maxRecordsPerFile", RECORDS).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at each magic, by Spark's text reader: plain files are read in byte splits, compressed ones as streams,
    and no task holds more than a piece. `n` orders the pieces of a split (archive, block)."""
    raw = spark.read.option("lineSep", MAGIC.decode()).option("pathGlobFilter", "part-*").text(path)
    meta = F.col("_metadata")
    return raw.select(meta["file_path"].alias("archive"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("n"), "value")


def candidates(p: DataFrame) -> DataFrame:
    """Of each piece its size, whether it ends with the lines that end a record, how many bytes after the magic the record's
    successor must begin (null: no length), whether the record ends within the piece, and its fields and digest."""
    value, data = F.col("value"), F.col("value").cast("binary")
    crlf = F.lit("\r\n\r\n")
    head = F.when(F.contains(value, crlf), F.substring_index(value, "\r\n\r\n", 1))
    field = lambda c, name: F.nullif(F.regexp_extract(c, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    p = p.withColumn("head", head).withColumn("from", F.octet_length("head") + 4)
    p = p.withColumn("record", F.col("from") + field(F.col("head"), "Content-Length").try_cast("long") + 4)
    rest = F.substring(data, F.col("from") + 1, F.octet_length(data)).cast("string")
    p = p.withColumn("inner", F.when(F.contains(rest, crlf), F.substring_index(rest, "\r\n\r\n", 1)))
    size = F.octet_length(data).cast("long")
    # the lines that end a record may begin with the end of a magic
    tail = lambda end: F.substring(data, (end - 3).cast("int"), F.lit(4)) == crlf.cast("binary")
    closed = F.coalesce((F.col("record") <= size) & tail(F.col("record")), F.lit(False))
    begin = F.col("from") + F.octet_length("inner") + 4
    h = F.col("head")
    return p.select(
        "archive", "block", "n", size.alias("size"), (F.coalesce((size >= 4) & tail(size), F.lit(False)) | (value == "\r\n")).alias("ends"), "record", closed.alias("closed"), begin.cast("long").alias("begin"),
        number(field(h, "WARC-Record-ID")).alias("page_id"), field(h, "WARC-Target-URI").alias("url"), field(F.col("inner"), "Content-Length").try_cast("long").alias("payload_bytes"),
        F.regexp_replace(field(h, "WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"), field(h, "WARC-Type").alias("record_type"), number(field(h, "WARC-Refers-To")).alias("refers_to"),
        F.when(closed & (field(h, "WARC-Type") == "response"), base32_sha1(F.substring(data, begin + 1, (F.col("record") - 4 - begin).cast("int")))).alias("found"),
    )


def jumps(at: np.ndarray, after: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by offset: the candidate that each one's successor is (itself, where there is none), and whether the
    successor lies beyond the last candidate. fits: a record may end before this candidate."""
    n = len(at)
    place = np.minimum(np.searchsorted(at, after), n - 1)
    inside = (at[place] == after) & fits[place] & (after > at)
    return np.where(inside, place, np.arange(n)), after > at[-1]


def ends_of(jump: np.ndarray) -> np.ndarray:
    """Where each candidate's chain ends, by pointer jumping."""
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def reachable(jump: np.ndarray, start: int) -> np.ndarray:
    """Which candidates the chain from `start` comes to: the reached set doubles with the length of the jumps."""
    seen = np.zeros(len(jump), bool)
    seen[start] = True
    while True:
        seen[jump[seen]] = True
        further = jump[jump]
        if np.array_equal(further, jump):
            return seen
        jump = further


def _offsets(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """A split's candidates in order, with offsets counted from the split's first piece; jumps; which leave the split."""
    rows = rows.sort_values("n", ignore_index=True)
    step = rows["size"].to_numpy(np.int64) + len(MAGIC)
    start = np.cumsum(step) - step
    rows["at"] = start - len(MAGIC)
    rows["after"] = np.where(rows["record"].isna(), -1, start + rows["record"].fillna(0).to_numpy(np.int64))
    rows["total"] = step.sum()
    fits = np.r_[True, rows["ends"].to_numpy(bool)[:-1]]
    jump, leaves = jumps(rows["at"].to_numpy(), rows["after"].to_numpy(), fits)
    return rows, jump, leaves


def _contract(rows: pd.DataFrame) -> pd.DataFrame:
    """Each candidate of a split with the offset at which its chain leaves the split (null: it doesn't)."""
    rows, jump, leaves = _offsets(rows)
    last = ends_of(jump)
    rows["leave"] = pd.array(np.where(leaves[last], rows["after"].to_numpy()[last], 0), "Int64")
    rows.loc[~leaves[last], "leave"] = pd.NA
    rows["first"] = rows.index == 0
    return rows[["archive", "block", "n", "at", "leave", "first", "ends", "total"]]


def _chain(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that its entry (an offset) leads to."""
    rows, jump, leaves = _offsets(rows)
    start = np.flatnonzero(rows["at"].to_numpy() == rows["entry"].iloc[0])
    keep = reachable(jump, int(start[0])) if len(start) else np.zeros(len(rows), bool)
    rows["inside"] = jump != np.arange(len(rows))
    rows["leaves"] = leaves
    return rows.loc[keep, ["archive", "block", "n", "at", "after", "inside", "leaves", "closed"]]


def chain(found: DataFrame) -> DataFrame:
    """archive, n, at and after of the records that the chain from each archive's start comes to, of candidates() stored. A
    split's chains are contracted in one task, to the offset where each leaves the split; splits are joined by pointer jumping
    over these offsets, in rounds logarithmic in the splits of an archive; then each split keeps what its entry leads to.
    A record stays if it ends within its piece, or if another record or the archive's end follows it."""
    narrow = found.select("archive", "block", "n", "size", "ends", "record", "closed")
    by = ["archive", "block"]
    local = C.stored(narrow.groupBy(*by).applyInPandas(_contract, "archive string, block long, n long, at long, leave long, first boolean, ends boolean, total long"), "warc-splits")
    w = Window.partitionBy("archive").orderBy("block")
    splits = local.groupBy(*by).agg(F.max("total").alias("total"), F.max_by("ends", "n").alias("ends"))
    splits = splits.select(
        *by, F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.coalesce(F.lag("ends").over(w), F.lit(True)).alias("fits"),
        (F.sum("total").over(Window.partitionBy("archive")) - len(MAGIC)).alias("stop"), F.last("ends").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("closes"),
        F.count("*").over(Window.partitionBy("archive")).alias("splits"),
    )
    splits = C.stored(splits, "warc-bases")
    most = splits.agg(F.max("splits")).first()[0] or 0
    known = local.join(splits, by).where("NOT first OR fits").select(*by, (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("leave")).alias("to"))
    start = splits.select("archive", F.lit(0).cast("long").alias("at")).distinct()
    reached = start
    if most > 1:
        nodes = start.unionByName(known.where("to IS NOT NULL").select("archive", F.col("to").alias("at"))).distinct()
        edges = C.stored(nodes.join(known.where("to IS NOT NULL"), ["archive", "at"]).select("archive", "at", "to"), "warc-jumps")
        for _ in range(int(most).bit_length()):
            more = reached.join(edges, ["archive", "at"]).select("archive", F.col("to").alias("at"))
            reached = C.stored(reached.unionByName(more).distinct(), "warc-reached")
            on = edges.select("archive", F.col("at").alias("to"), F.col("to").alias("next"))
            edges = C.stored(edges.join(on, ["archive", "to"]).select("archive", "at", F.col("next").alias("to")), "warc-jumps")
    entries = reached.join(known, ["archive", "at"]).join(splits.select(*by, "base"), by).select(*by, (F.col("at") - F.col("base")).alias("entry"))
    kept = narrow.join(entries, by).groupBy(*by).applyInPandas(_chain, "archive string, block long, n long, at long, after long, inside boolean, leaves boolean, closed boolean")
    kept = kept.join(splits, by).select("archive", "n", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("after")).alias("after"), "inside", "leaves", "closed", "stop", "closes")
    followed = reached.select("archive", F.col("at").alias("after"), F.lit(True).alias("followed"))
    real = known.select("archive", F.col("at").alias("after"))
    followed = followed.join(real, ["archive", "after"], "left_semi")
    ok = F.col("closed") | F.col("inside") | (F.col("leaves") & (F.coalesce("followed", F.lit(False)) | ((F.col("after") == F.col("stop")) & F.col("closes"))))
    return kept.where("after > at AND at >= 0").join(followed, ["archive", "after"], "left").where(ok).select("archive", "n", "at", "after", "closed")


def _bodies(spark: SparkSession, path: str, broken: DataFrame) -> DataFrame:
    """n and digest of the payloads of records (archive, n, at, after, begin) that hold magic, put together from their pieces.
    The archives with such records are read again and their pieces stored, so sizes and bytes are of one reading."""
    mine = C.stored(pieces(spark, path).join(broken.select("archive").distinct(), "archive", "left_semi"), "warc-pieces")
    by = ["archive", "block"]
    step = F.octet_length("value").cast("long") + len(MAGIC)
    split = Window.partitionBy(*by).orderBy("n")
    before = Window.partitionBy("archive").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = mine.groupBy(*by).agg(F.sum(step).alias("total"))
    base = sums.select(*by, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    places = mine.select(*by, "n", F.coalesce(F.sum(step).over(split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")).join(base, by)
    places = places.select(*by, F.col("n").alias("piece"), (F.col("base") + F.col("start") - len(MAGIC)).alias("place"))
    own = broken.select("archive", F.col("at").alias("place"), F.struct("n", "at", "after", "begin").alias("own"))
    marks = places.join(own, ["archive", "place"], "left")
    # records don't overlap: the last one that begins at a piece or before it is the one that may hold the piece
    here = F.last("own", True).over(Window.partitionBy(*by).orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    last = marks.groupBy(*by).agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("place"))).alias("last"))
    carried = last.select(*by, F.last("last", True).over(before).alias("carried"))
    held = marks.withColumn("here", here).join(carried, by).withColumn("own", F.coalesce("here", "carried"))
    parts = held.where("place < own.after").select("archive", "piece", "place", "own")
    text = mine.select("archive", F.col("n").alias("piece"), "value").join(parts, ["archive", "piece"])
    one = text.groupBy("own").agg(F.array_sort(F.collect_list(F.struct("place", F.col("value").cast("binary").alias("value")))).alias("v"))
    whole = F.array_join(F.transform("v", lambda x: x["value"].cast("string")), MAGIC.decode()).cast("binary")
    size = F.col("own.after") - 4 - F.col("own.at") - len(MAGIC) - F.col("own.begin")
    return one.select("own.n", base32_sha1(F.substring(whole, (F.col("own.begin") + 1).cast("int"), size.cast("int"))).alias("body"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, payloads left out."""
    found = C.stored(candidates(pieces(spark, path)), "warc-candidates")
    kept = C.stored(chain(found), "warc-chain")
    rows = found.drop("closed").join(kept.select("n", "at", "closed"), "n")
    digest = F.col("found")
    broken = C.stored(kept.where("NOT closed").join(found.where("record_type = 'response'").select("n", "begin"), "n"), "warc-broken")
    if not broken.isEmpty():
        rows = rows.join(_bodies(spark, path, broken), "n", "left")
        digest = F.coalesce("found", "body")
    ok = F.when((F.col("record_type") == "response") & F.col("begin").isNotNull(), digest.eqNullSafe(F.col("payload_digest")))
    return rows.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", ok.alias("digest_ok"), F.col("at").alias("offset"), "archive")
