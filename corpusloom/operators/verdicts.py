"""A model's verdicts on texts, asked for once: a table keyed by content that grows with each run.

Rows that hold one text about one topic share a key. What the table has isn't asked for again (an anti-join); each other key is
asked for once, and its verdict appended. No answer is no verdict: it isn't stored, so a later run asks again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.backend import Backend, answers
from ..sources.scratch import exists, stored

SCHEMA = "key string, verdict boolean"
PROMPT = "Is this practical teaching about {}? Answer yes or no.\n\n"


def content_key(topic: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(topic, F.lit("")), F.lit("\x00"), text), 256)


class Verdicts:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def known(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)

    def ask(self, rows: DataFrame, backend: Backend) -> int:
        """Asks for what isn't known of rows (topic, sample); returns how many keys that were."""
        new = rows.where("sample IS NOT NULL").select("topic", "sample", content_key(F.col("topic"), F.col("sample")).alias("key"))
        new = new.groupBy("key").agg(F.first("topic").alias("topic"), F.first("sample").alias("sample")).join(self.known(), "key", "left_anti")
        prompt = F.concat(F.lit(PROMPT.split("{}")[0]), F.regexp_replace(F.coalesce("topic", F.lit("")), "_", " "), F.lit(PROMPT.split("{}")[1]), "sample")
        said = stored(new.select("key", F.lower(F.btrim(answers(prompt, backend))).alias("said")), "answers")
        verdicts = said.where("said <> ''").select("key", F.col("said").startswith("y").alias("verdict"))
        verdicts.write.parquet(f"{self.path}/{uuid.uuid4().hex}")
        return said.count()

    def of(self, rows: DataFrame, backend: Backend) -> DataFrame:
        """rows (topic, sample, and others) with `verdict`: true, false, or null where there is no sample or no answer."""
        self.ask(rows, backend)
        keyed = rows.withColumn("key", content_key(F.col("topic"), F.col("sample")))
        return keyed.join(self.known().dropDuplicates(["key"]), "key", "left").drop("key")


def unclassified(files: DataFrame, classified: DataFrame) -> DataFrame:
    """file and the 1,200 characters that a classifier reads, of files (file, text) of 200 characters and more (blanks at the
    ends don't count) that it hasn't seen."""
    long = files.where(F.length(F.btrim("text", F.lit(" \t\n\r\f\x0b"))) >= 200).select("file", F.substring("text", 1, 1200).alias("sample"))
    return long.join(classified.select("file"), "file", "left_anti")


def not_skipped(candidates: DataFrame, skipped: DataFrame) -> DataFrame:
    """Candidates whose identifier isn't on the skip list (fetched in vain, rejected, or junk before)."""
    return candidates.join(skipped.select("identifier").distinct(), "identifier", "left_anti")
