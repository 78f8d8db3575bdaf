"""Connectors: candidates of sources as a Python data source, and the files a corpus keeps.

A source's search results lie as JSON lines in <folder>/<source>/<node>.jsonl (what a crawler of that source leaves). The data
source `corpus_candidates` has a partition for each such file, pushes filters on source and node down to the listing, and keeps
at most 80 candidates of a search. Lower bounds on score, year and comments, and equal rights, are pushed down too: a file whose
<node>.stats.json (the largest value of each column) can't meet one isn't opened, and rows that don't meet them don't leave the
reader. An unreadable line or file gives no candidates and no error.
"""

from __future__ import annotations

import gzip
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition
from pyspark.sql.types import StringType

# Candidates of one search; endings of an archive's text files, best first.
MAX_CANDIDATES = 80
TEXT_ENDINGS = ["_djvu.txt", "_hocr_searchtext.txt.gz", "_text.txt"]
SCHEMA = "source string, node string, rank int, identifier string, title string, url string, text string, score long, year long, comments long, rights string"
NUMBERS = ("score", "year", "comments")
# What a source's own search keeps.
RULES = {"stackexchange": "score >= 1", "hathitrust": "rights = 'Full view'", "core": "year >= 1980", "dtic": "rights = 'public'", "reddit": "comments >= 5 OR score >= 10"}
COMMENT_SCORE, COMMENT_CHARS, COMMENTS, ANSWERS = 1, 40, 30, 3


class SearchFile(InputPartition):
    def __init__(self, path: str, source: str, node: str) -> None:
        super().__init__(None)
        self.path, self.source, self.node = path, source, node


class CandidateReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.most = options["path"], int(options.get("most", MAX_CANDIDATES))
        self.only: dict[str, set[str]] = {}
        self.least: dict[str, int] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute in (("source",), ("node",)):
                self.only[f.attribute[0]] = self.only.get(f.attribute[0], values) & values
            elif values is not None and f.attribute == ("rights",):
                self.only["rights"] = self.only.get("rights", values) & values
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute[0] in NUMBERS and len(f.attribute) == 1:
                low = f.value + isinstance(f, GreaterThan)
                self.least[f.attribute[0]] = max(self.least.get(f.attribute[0], low), low)
            else:
                yield f

    def partitions(self) -> list[SearchFile]:
        fits = lambda kind, name: kind not in self.only or name in self.only[kind]
        out = []
        for source in sorted(os.listdir(self.folder)) if os.path.isdir(self.folder) else []:
            where = os.path.join(self.folder, source)
            if os.path.isdir(where) and fits("source", source):
                out += [SearchFile(os.path.join(where, f), source, f[:-6]) for f in sorted(os.listdir(where)) if f.endswith(".jsonl") and fits("node", f[:-6]) and self._may_meet(os.path.join(where, f[:-6]))]
        return out

    def _may_meet(self, stem: str) -> bool:
        """Whether a file's statistics, if it has any, allow a row that meets the lower bounds."""
        if not self.least:
            return True
        try:
            with open(f"{stem}.stats.json", encoding="utf-8") as f:
                most = json.load(f)
            return all(not isinstance(most.get(k), (int, float)) or most[k] >= v for k, v in self.least.items())
        except (OSError, ValueError, AttributeError):
            return True

    def read(self, partition: SearchFile | None) -> Iterator[tuple]:
        if partition is None:  # there are no files
            return
        rank = 0
        try:
            with open(partition.path, encoding="utf-8", errors="replace") as lines:
                for line in lines:
                    try:
                        row = json.loads(line)
                    except ValueError:
                        continue
                    if not isinstance(row, dict) or rank >= self.most:
                        continue
                    rank += 1
                    text = lambda k: None if row.get(k) is None else str(row[k])  # noqa: B023, E731
                    number = lambda k: int(row[k]) if isinstance(row.get(k), (int, float)) else None  # noqa: B023, E731
                    if any(number(k) is None or number(k) < v for k, v in self.least.items()) or "rights" in self.only and text("rights") not in self.only["rights"]:
                        continue
                    yield partition.source, partition.node, rank, text("identifier"), text("title"), text("url"), text("text"), *map(number, NUMBERS), text("rights")
        except OSError:
            return


class Candidates(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpus_candidates"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CandidateReader:
        return CandidateReader(self.options)


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates under a folder that every executor sees (see the module's text)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Candidates)
    return spark.read.format("corpus_candidates").load(folder)


def search(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """A source's candidates that its rule lets pass; simple rules reach the reader."""
    found = candidates(spark, folder).where(F.col("source") == source)
    return found.where(RULES[source]) if source in RULES else found


def threads(posts: DataFrame, body: DataFrame) -> DataFrame:
    """Threads (thread, text) of posts' bodies (thread, text) and comments (thread, seq, score, text): up to 30 comments, in order,
    of score 1 and 40 characters or more each. A thread without comments is its body."""
    fit = posts.where((F.col("score") >= COMMENT_SCORE) & (F.length("text") >= COMMENT_CHARS))
    first = fit.withColumn("i", F.row_number().over(Window.partitionBy("thread").orderBy("seq"))).where(F.col("i") <= COMMENTS)
    said = first.groupBy("thread").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("c"))
    return body.join(said, "thread", "left").select("thread", F.concat_ws("\n\n", F.col("text"), F.transform("c", lambda x: x["text"])).alias("text"))


def best_answers(answers: DataFrame) -> DataFrame:
    """The three answers (question, seq, score, text) of a question that have the most votes, one at least each."""
    order = Window.partitionBy("question").orderBy(F.desc("score"), "seq")
    return answers.where("score >= 1").withColumn("place", F.row_number().over(order)).where(F.col("place") <= ANSWERS)


def successes(fetched: DataFrame, most: int = 5, saves: int = 3) -> DataFrame:
    """Candidates (source, node, rank, saved, high_value) that a search gets to: the first 5 (8 if one of the first 8 has high
    value), until three are saved."""
    w = Window.partitionBy("source", "node")
    ordered = w.orderBy("rank")
    reach = F.when(F.max(F.col("high_value") & (F.col("rank") <= 8)).over(w), most + 3).otherwise(most)
    before = F.coalesce(F.sum(F.col("saved").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return fetched.withColumns({"_reach": reach, "_before": before}).where("rank <= _reach AND _before < " + str(saves)).drop("_reach", "_before")


def vault_files(spark: SparkSession, folder: str) -> DataFrame:
    """file and whole text of the .txt files of a vault."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("text"))


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON state file by an explicit schema; no file, or one that isn't JSON, is an empty table."""
    try:
        rows = spark.read.schema(schema + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    kept = rows.drop("_corrupt")
    return kept.where(F.coalesce(*[F.col(c).cast("string") for c in kept.columns]).isNotNull())


def saved_fingerprints(spark: SparkSession, path: str, most: int = 50_000) -> DataFrame:
    """seq and fp (64 bits as a long) of a file of hexadecimal lines: blank and invalid lines are passed over, the last `most`
    kept. A file is in one piece, its lines in order, so its place is the line's number."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("seq", "line"))
    good = lines.select("seq", F.lower(F.btrim("line")).alias("line")).where(F.col("line").rlike("^(0x)?[0-9a-f]{1,16}$"))
    bits = F.lpad(F.regexp_replace("line", "^0x", ""), 16, "0")
    high, low = F.conv(F.left(bits, F.lit(8)), 16, 10).cast("bigint"), F.conv(F.right(bits, F.lit(8)), 16, 10).cast("bigint")
    return good.select("seq", F.shiftleft(high, 32).bitwiseOR(low).alias("fp")).orderBy(F.desc("seq")).limit(most)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.hex(fp))


@F.pandas_udf(StringType())
def decoded(content: pd.Series, url: pd.Series) -> pd.Series:
    """The text of a fetched body: gzip is opened, a PDF (no reader here) and what can't be opened are empty."""

    def one(body, where) -> str:
        body, where = bytes(body or b""), (where or "").lower()
        try:
            if where.endswith(".gz") or body[:2] == b"\x1f\x8b":
                body = gzip.decompress(body)
        except (OSError, EOFError):
            return ""
        return "" if where.endswith(".pdf") or body[:5] == b"%PDF-" else body.decode("utf-8", "replace")

    return pd.Series([one(b, u) for b, u in zip(content, url, strict=True)], dtype=object)


def fetched(spark: SparkSession, folder: str) -> DataFrame:
    """file and text of raw bodies in a folder."""
    return spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), decoded("content", "path").alias("text"))


def best_file(files: Column, restricted: Column) -> Column:
    """The file of an archive item to read: the first that has the best ending; none of a restricted item."""
    first = lambda end: F.try_element_at(F.filter(files, lambda f: F.lower(f).endswith(end)), F.lit(1))
    return F.when(~F.coalesce(restricted, F.lit(False)), F.coalesce(*[first(e) for e in TEXT_ENDINGS]))
