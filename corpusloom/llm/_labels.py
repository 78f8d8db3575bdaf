"""The bounded sample of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that no classifier may learn from. A null doc_id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(labels: DataFrame, target: str, most: int) -> DataFrame:
    """doc_id and label of about `most` rows of labels that aren't held out, chosen by a hash of doc_id. Of several
    labels of one doc_id the largest counts; null ids and labels are left out."""
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[target].cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    n = max(1, labels.count())
    share = min(1.0, most / n)
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, most: int) -> tuple[DataFrame, int, int]:
    """doc_id, y and text of the sample, and the numbers of labels 0 and 1 in it. The sample's ids are broadcast: their number is
    bounded by `most`, up to the hash's spread."""
    ids = [(r.doc_id, r.y) for r in sample(labels, target, most).toLocalIterator()]
    spark = docs.sparkSession
    frame = spark.createDataFrame(ids, "doc_id long, y int")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")).where("doc_id IS NOT NULL")
    ones = sum(y > 0 for _, y in ids)
    return rows.join(F.broadcast(frame), "doc_id").select("doc_id", "y", "text"), len(ids) - ones, ones
