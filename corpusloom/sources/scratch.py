"""Tables that cut the lineage of iterative plans, in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def base_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local master may do without the setting: it gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.conf.get("spark.master", "") or ""):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    path = f"{base_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
