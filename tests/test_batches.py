"""What Python workers are given at once."""

import tracemalloc

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import simhash
from corpusloom.sources.tables import load
from tests.test_text import plain_fingerprint


def test_batches_of_loaded_tables_are_small(spark):
    """Before, a batch held 10,000 rows of any length."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64()), pa.array([b.num_rows], pa.int64())], names=["size", "rows"]) for b in batches)

    got = load(spark, "/root/testdata/sf0.1", "documents").select("text").mapInArrow(sizes, "size long, rows long").collect()
    assert sum(b["rows"] for b in got) == 10_000 and max(b["size"] for b in got) < 6 << 20


def test_series_of_functions_are_small(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    size = F.pandas_udf(lambda text: pd.Series([text.str.len().sum()] * len(text)), "long")
    docs = load(spark, "/root/testdata/sf0.1", "documents")
    assert docs.select(F.max(size("text"))).first()[0] < 6 << 20 < docs.select(F.sum(F.length("text"))).first()[0]


def test_a_long_text_is_fingerprinted_in_little_room():
    """Before, the numbers of all its windows were held at once."""
    text = "Long naïve text, 漢字 and more. " * 100_000
    tracemalloc.start()
    simhash.votes(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


@pytest.mark.parametrize("block", [1, 7, 50])
def test_blocks_of_windows_make_the_same_fingerprint(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block, raising=False)
    for text in ("", "abcde", "abcdef", "abcdefg", "naïve Übung 漢字 text, long enough", "xy" * 50):
        assert simhash.fingerprint_of(text) % (1 << 64) == plain_fingerprint(text)
