"""Queries over documents with empty, blank and missing texts against their SQL."""

import duckdb
import pytest

from corpusloom import catalog

from .test_queries import plain

TEXTS = ["", " ", "\n", " \t\r\n \x0b\f", None, "\u00a0", "\u00a0\n\n", "-", "- -\n12 %", "1", "a", "Ein Wort.\n\nshort\n", "\U0001f600 x", "word " * 30, "\n" * 7000, " " * 3000 + "a", "x" * 4000]


def against_sql(spark, path, name):
    rows = [(i, t, "en", "src1", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{path}/documents.parquet")
    got = catalog.QUERIES[name](spark, str(path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    cur = con.execute(catalog.ORACLE[name])
    names = [d[0] for d in cur.description]
    return plain(got.select(*names).collect()), plain(cur.fetchall())


@pytest.mark.parametrize("name", ["letter_ratio", "ocr_metrics", "ocr_verdict", "density_multi_window", "topic_density"])
def test_texts_without_anything(spark, tmp_path, name):
    got, want = against_sql(spark, tmp_path, name)
    assert got == want and len(got) == len(TEXTS)
