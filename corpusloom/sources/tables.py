"""Stand-in tables: the vault of documents, source settings, claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import batches
from ..functions.lists import SOURCES


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table. What Python sees of it comes in small batches: a batch of 10,000 long texts, as pandas and as results, is too
    much for the workers beside an executor."""
    batches.small(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_config(spark: SparkSession) -> DataFrame:
    """One row for each source: a dimension of fixed size."""
    return spark.createDataFrame([(f"src{i}", *s) for i, s in enumerate(SOURCES)], "source string, source_name string, min_hits int, html_gate boolean, min_length int, tiers string, low_trust boolean, is_reference boolean")


def vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source's settings; a source that isn't configured is "recovered" with default settings."""
    docs = load(spark, sf_dir, "documents")
    out = docs.join(F.broadcast(source_config(spark)), "source", "left")
    return out.select(
        "doc_id", "text", "lang", "source", F.coalesce("source_name", F.lit("recovered")).alias("source_name"), F.coalesce("min_hits", F.lit(2)).alias("min_hits"), F.coalesce("html_gate", F.lit(False)).alias("html_gate"),
        F.coalesce("min_length", F.lit(2500)).alias("min_length"), F.coalesce("low_trust", F.lit(False)).alias("low_trust"), F.coalesce("is_reference", F.lit(False)).alias("is_reference"),
    )
