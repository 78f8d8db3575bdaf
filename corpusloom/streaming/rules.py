"""Event streams: reading what is there to the end, into a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import base_folder


def drain(spark: SparkSession, path: str, fn: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """fn over a stream of the parquet files at `path`, run until all are read; the result is a table in the shared folder.
    In complete mode the last batch is the result, in append mode all are. A batch has a folder of its own, which a replay
    of the batch writes anew: no row counts twice."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = fn(spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path if not name.endswith(".parquet") or _is_folder(spark, path) else f"{folder}/{name[:-8]}*.parquet"))
    out = f"{base_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/{'all' if mode == 'complete' else f'batch={number}'}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows/all" if mode == "complete" else f"{out}/rows").select(*stream.columns)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
