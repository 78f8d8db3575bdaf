"""Every registered query of the library's own against its SQL, on the smallest tables; and the guard of the entry file."""

import datetime
import decimal
import os
import subprocess
import sys

import pytest

from corpusloom import catalog

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(rows):
    def value(v):
        if isinstance(v, (float, decimal.Decimal)):
            return round(float(v), 6)
        return str(v) if isinstance(v, datetime.datetime) else v

    return sorted(repr([value(v) for v in r]) for r in rows)


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    cur = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = [[r[names.index(c)] for c in cols] for r in cur.fetchall()]
    assert plain([[r[c] for c in cols] for r in got.collect()]) == plain(want)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.ORACLE])
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() >= 0


def test_entry_imports_without_the_llm_folder(tmp_path):
    os.makedirs(tmp_path / "corpusloom")
    for f in ("__spark_entry__.py",):
        os.symlink(f"{REPO}/{f}", tmp_path / f)
    for f in os.listdir(f"{REPO}/corpusloom"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{REPO}/corpusloom/{f}", tmp_path / "corpusloom" / f)
    out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.stdout.split() == [str(len(catalog.QUERIES)), "False"], out.stderr
