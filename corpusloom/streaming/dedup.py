"""Near-duplicate removal across runs: a stored index of kept fingerprints that grows by micro-batch.

The index has a folder for each batch number, with the fingerprints kept by it and their bands (the groups of bits by which
near ones meet). A batch is compared with the bands of earlier batches only, then goes through the greedy selection among
itself in order of arrival, so the rows kept are those of one pass over everything in order. A batch that is run again reads the same
earlier batches and writes its own folder anew: nothing counts twice. Rejected rows never enter the index.

Rows are topic, doc_id, fp; a null fp (a text too short to compare) is kept and not indexed. Rows of a null topic meet none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lists import HAMMING
from ..operators import simhash
from ..sources.scratch import exists, stored

KEPT = "topic string, doc_id long, fp long, batch int"
BANDS = "topic string, fp long, band int, key long, batch int"


class Index:
    """Kept fingerprints at `path`, within `most` bits of which a new row is a copy."""

    def __init__(self, spark: SparkSession, path: str, most: int = HAMMING) -> None:
        self.spark, self.path, self.most = spark, path, most

    def _before(self, part: str, schema: str, number: int) -> DataFrame:
        if not exists(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}").where(F.col("batch") < number)

    def kept(self) -> DataFrame:
        return self._before("kept", KEPT, (1 << 31) - 1).drop("batch")

    def add(self, prints: DataFrame, number: int, order: tuple[str, ...] = ("doc_id",)) -> None:
        """Rows of micro-batch `number`, in the order of the columns named."""
        new = stored(prints.select("topic", "doc_id", "fp", *[c for c in order if c != "doc_id"]), "arrivals")
        long = new.where("fp IS NOT NULL")
        bands = simhash.bands(long.select("topic", "fp").distinct(), self.most)
        old = self._before("bands", BANDS, number).select("topic", "band", "key", F.col("fp").alias("old"))
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("old"))) <= self.most
        copies = bands.join(old, ["topic", "band", "key"]).where(near).select("topic", "fp").distinct()
        fresh = simhash.greedy_keep(long.join(copies, ["topic", "fp"], "left_anti"), [F.col(c) for c in order], stored)
        fresh = stored(fresh, "fresh")
        short = new.where("fp IS NULL").select("topic", "doc_id", "fp")
        self._write(simhash.bands(fresh.select("topic", "fp"), self.most), "bands", number)
        self._write(fresh.select("topic", "doc_id", "fp").unionByName(short), "kept", number)

    def _write(self, rows: DataFrame, part: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={number}")


def run(arrivals: DataFrame, path: str) -> None:
    """Reads a stream of arrivals to its end into the index at `path`; started again, it goes on with the next batch."""
    index = Index(arrivals.sparkSession, path)
    query = arrivals.writeStream.foreachBatch(lambda batch, number: index.add(batch, number))
    query.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
