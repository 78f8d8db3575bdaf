"""Reports and states as files, one for each row: written beside their places, and put there when the whole write has succeeded.

The data source `corpus_files` takes rows (name, content). Tasks write to a folder of the write's own under the target; the
commit moves the files over those of the same names, an abort (a failed task ends the write) removes them and leaves the old
files as they were. Options: `keep` true leaves files that are there; `dry_run` true only reports what would happen. Null
content deletes the file: what a cleanup asks for. The target must be a folder that all executors see.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SCHEMA = "name string, content string"


@dataclass
class Staged(WriterCommitMessage):
    names: list[tuple[str, str | None]]  # a file's name, and where its new content lies (None: delete)


class FileWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.target = options["path"].removeprefix("file://")
        self.keep, self.dry = (options.get(k, "false").lower() == "true" for k in ("keep", "dry_run"))
        self.stage = os.path.join(self.target, f".staged-{uuid.uuid4().hex}")
        os.makedirs(self.stage)  # here and not in tasks: one that still runs after an abort must not make it anew

    def write(self, rows: Iterator[Row]) -> Staged:
        names = []
        for r in rows:
            if not r.name or r.name != os.path.basename(r.name) or r.name.startswith("."):
                raise ValueError(f"not the name of a file: {r.name!r}")
            place = None
            if r.content is not None:
                place = os.path.join(self.stage, uuid.uuid4().hex)
                with open(place, "w", encoding="utf-8") as f:
                    f.write(r.content)
            names.append((r.name, place))
        return Staged(names)

    def commit(self, messages: list[Staged | None]) -> None:
        for name, place in (x for m in messages if m for x in m.names):
            there = os.path.join(self.target, name)
            if self.dry or self.keep and os.path.exists(there):
                continue
            if place is not None:
                os.replace(place, there)
            elif os.path.exists(there):
                os.remove(there)
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        for _ in range(10):  # a task that still runs may add a file meanwhile
            shutil.rmtree(self.stage, ignore_errors=True)
            if not os.path.isdir(self.stage):
                break


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpus_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options)


def save(rows: DataFrame, folder: str, keep: bool = False, dry_run: bool = False) -> None:
    """Writes rows (name, content), one of a name, into a folder."""
    rows.sparkSession.dataSource.register(Files)
    where = {"path": folder, "keep": str(keep), "dry_run": str(dry_run)}
    rows.select("name", "content").write.format("corpus_files").options(**where).mode("append").save()


def states(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """Plans, material lists, videos and tasks as JSON documents: a file for each value of `name`, of its rows in order."""
    doc = F.to_json(F.array_sort(F.collect_list(F.struct(*fields))))
    return rows.groupBy(F.concat(F.col(name), F.lit(".json")).alias("name")).agg(doc.alias("content"))


def coherence(findings: DataFrame, topic: str) -> DataFrame:
    """The coherence report (kind, line) of a book: a row only if there is a finding, so an earlier file stays after a cycle
    without any."""
    parts = findings.groupBy("kind").agg(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat(F.lit("- "), F.col("line"))))).alias("lines"))
    sections = F.transform(F.array_sort(F.collect_list(F.struct("kind", "lines"))), lambda s: F.concat(F.lit("## "), s["kind"], F.lit("\n\n"), s["lines"]))
    whole = parts.agg(sections.alias("s"), F.count("*").alias("n")).where("n > 0")
    return whole.select(F.lit("coherence.md").alias("name"), F.concat(F.lit(f"# Coherence of {topic}\n\n"), F.array_join("s", "\n\n")).alias("content"))


def cleanup(files: DataFrame, used: DataFrame) -> DataFrame:
    """What a vault's cleanup does with its files (name, hits): all go once a book is made of them; those that no chapter used and
    in which no term was found are junk."""
    return files.join(used.select("name").distinct().withColumn("used", F.lit(True)), "name", "left").select("name", F.lit(None).cast("string").alias("content"), (F.col("used").isNull() & (F.col("hits") == 0)).alias("junk"))


def duplicates(files: DataFrame, kept: DataFrame) -> DataFrame:
    """The report of a dedup run over files (name, bytes), of which `kept` (name) stay: files and bytes kept and removed."""
    marked = files.join(kept.select("name").distinct().withColumn("stays", F.lit(True)), "name", "left").withColumn("stays", F.coalesce("stays", F.lit(False)))
    size = lambda c, n: F.coalesce(F.sum(F.when(c, F.col("bytes"))), F.lit(0)).alias(n)
    stays = F.col("stays")
    return marked.agg(F.count_if(stays).alias("kept"), F.count_if(~stays).alias("removed"), size(stays, "bytes_kept"), size(~stays, "bytes_removed"))
