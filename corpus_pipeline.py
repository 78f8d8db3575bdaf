"""The training-data pipeline: five stages over documents, each a table in the shared folder before the next begins.

All stages but the last keep the columns of documents, whatever their names, and every document that they don't reject:
- toxicity: a null or empty text scores as one without passages and stays; repeated rows fare alike.
- near_dedup: of a class the row with the least doc_id stays (null is the largest; of equal ids the text with the least
  hash, of equal rows one); documents without words are alike only if their texts are equal.
- suffix_dedup: a null text becomes empty; a document shorter than the window loses nothing; equal doc_ids don't cover
  each other; characters that a cut leaves in part go whole; n_chars follows the text.
- decontamination: null and empty texts hold no test item and stay; null items take no part.
- sentencepiece: a row a document, doc_id with its pieces; a null text has none.
A text of any length is one record of one task. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import _common, decontaminate, near_dedup, sentencepiece, suffix_dedup, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go."""
    return toxicity.clean(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return near_dedup.dedup(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the texts; all documents stay."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = suffix_dedup.dedup(docs, keep="text", carry=tuple(rest))
    made = {"doc_id": out["doc_id"], "text": out["kept"], "n_chars": F.char_length(out["kept"]).cast("long")}
    return out.select(*[(made[c] if c in made else out[f"carried_{rest.index(c)}"]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of each text, checked to decode to it."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: Trained scores, sampled sketches and sampled pieces have no SQL form; tests/llm/test_pipeline.py holds each stage, and run(),
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = _common.stored(stage(spark, docs, sf_dir), name)
    return docs
